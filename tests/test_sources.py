import gzip
import json

import pytest
from pyspark.sql import functions as F

from reviewloom.functions.versions import deployment_name, pipeline_name
from reviewloom.sources import metric_log, requests, reviews, splits
from reviewloom.sources.datasets import DatasetStore
from reviewloom.sources.label_maps import load_label_map, save_label_map


def test_review_lines(spark, tmp_path):
    lines = [
        '{"reviewText": "good", "overall": 5.0, "helpful": [1, 2]}',
        "{'reviewText': \"it's fine\", 'overall': 3}",
        "{'reviewText': None, 'overall': 1}",
        '{"overall": 2}',
    ]
    with gzip.open(tmp_path / "reviews.json.gz", "wt") as out:
        out.write("\n".join(lines))
    rows = reviews.read_reviews(spark, str(tmp_path / "reviews.json.gz"), partitions=3, literals=False).collect()
    good = sorted((r["reviewText"] or "", r["overall"]) for r in rows if r["_corrupt_record"] is None)
    assert good == [("", 2.0), ("good", 5.0), ("it's fine", 3.0)]
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == [lines[2]]


def test_literal_review_lines(spark, tmp_path):
    marker = tmp_path / "evaluated"
    lines = [
        "{'reviewText': None, 'overall': 1, 'helpful': [1, 2]}", "{'reviewText': \"it's None, 'x': True\", 'verified': True, 'overall': 4.0}",
        '{"reviewText": "json", "overall": 5.0}', "{'reviewText': u'caf\\xe9', 'helpful': (3, 4), 'summary': 'a' 'b', 'extra': None}",
        "{'reviewText': open('" + str(marker) + "', 'w')}", "{'reviewText': None", "[None, 1]", "{'overall': None, 'x': {None: 1}}",
        "(" * 300 + ")" * 300, "{'unixReviewTime': 1400000000, 'reviewText': None}", "nonsense",
    ]
    (tmp_path / "in").mkdir()
    for part in range(2):
        (tmp_path / "in" / f"{part}.json").write_text("\n".join(lines[part::2]))
    read = reviews.read_reviews(spark, str(tmp_path / "in"))
    rows = read.collect()
    good = [(r["reviewText"] or "", r["overall"], r["helpful"], r["summary"], r["unixReviewTime"]) for r in rows if r["_corrupt_record"] is None]
    want = [
        ("", None, None, None, None), ("", None, None, None, 1400000000), ("", 1.0, [1, 2], None, None), ("caf\xe9", None, [3, 4], "ab", None),
        ("it's None, 'x': True", 4.0, None, None, None), ("json", 5.0, None, None, None),
    ]
    assert sorted(map(str, good)) == sorted(map(str, want))
    assert sorted(r["_corrupt_record"] for r in rows if r["_corrupt_record"]) == sorted([lines[4], lines[5], lines[6], lines[8], lines[10]])
    assert tuple(reviews.line_counts(read).first()) == (11, 5) and not marker.exists()


def test_csv_keeps_every_text(spark, tmp_path):
    texts = ['say "hi"', "a\nb", "a\r\nb", "x,y", "back\\", "back\\\"q", "NA", "", None, "  pad  ", "\\N?", '"', "\t"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    splits.write_split_csv(df, str(tmp_path / "csv"))
    rows = splits.read_split_csv(spark, str(tmp_path / "csv"), df.schema).collect()
    assert sorted((r["i"], r["t"]) for r in rows) == list(enumerate(texts))


def test_parquet_reads_one_split_only(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "val")], "k int, split string")
    splits.write_split_parquet(df, str(tmp_path / "p"))
    val = splits.read_split_parquet(spark, str(tmp_path / "p"), "val")
    assert [r["k"] for r in val.collect()] == [2]
    assert "PartitionFilters: [isnotnull(split" in val._jdf.queryExecution().executedPlan().toString()


def test_dataset_versions(spark, tmp_path):
    store = DatasetStore(spark, str(tmp_path))
    assert store.register(spark.range(3).toDF("k"), "train_set", "first") == 1
    assert store.register(spark.range(5).toDF("k"), "train_set") == 2
    assert store.register(spark.range(2).toDF("k"), "val_set") == 1
    assert store.read("train_set").count() == 5 and store.read("train_set", 1).count() == 3
    with pytest.raises(LookupError):
        store.read("train_set", 9)
    with pytest.raises(LookupError):
        store.read("none")


def test_metric_log(spark, tmp_path):
    rows = [("r", "test_val", i, float(v)) for i, v in enumerate([1, 5, 9, 4, 12])]
    df = spark.createDataFrame(rows, "run_id string, name string, seq int, value double")
    metric_log.append_metrics(df.filter("seq > 1"), str(tmp_path / "m"))
    metric_log.append_metrics(df.filter("seq <= 1"), str(tmp_path / "m"))
    listed = metric_log.metric_lists(metric_log.read_metrics(spark, str(tmp_path / "m"))).orderBy("position").collect()
    assert [r["value"] for r in listed] == [1.0, 5.0, 9.0, 4.0, 12.0]


def test_row_metric_keeps_the_last_value(spark):
    rows = [(1, "a", 1, 0.1), (1, "a", 2, 0.2), (1, "b", 1, 0.3), (2, "a", 1, None)]
    df = spark.createDataFrame(rows, "t int, name string, seq int, value double")
    wide = metric_log.metric_rows(df, ["t"], ["a", "b"]).orderBy("t").collect()
    assert [tuple(r) for r in wide] == [(1, 0.2, 0.3), (2, None, None)]


def test_both_request_shapes(spark):
    plain = json.dumps({"data": [{"text": "one"}, {"text": None}, {"text": "three"}]})
    nested = json.dumps({"Inputs": {"data": [{"reviewText": "x"}]}, "GlobalParameters": 2.0})
    df = spark.createDataFrame([(1, plain), (2, nested), (3, '{"data": []}'), (4, "junk")], "request_id int, raw string")
    rows = requests.parse_requests(df).orderBy("request_id", "pos").collect()
    assert [tuple(r) for r in rows] == [
        (1, 1.0, None, 0, "one"), (1, 1.0, None, 1, None), (1, 1.0, None, 2, "three"), (2, 2.0, None, 0, "x"),
        (3, 1.0, None, None, None), (4, 1.0, requests.UNREADABLE, None, None),
    ]
    scored = requests.parse_requests(df).selectExpr("request_id", "pos", "length(text) AS prediction")
    replies = {r["request_id"]: (r["response"], r["n_items"]) for r in requests.responses(scored).collect()}
    assert replies == {1: ("[3,null,5]", 3), 2: ("[1]", 1), 3: ("[]", 0), 4: ("[]", 0)}


def test_reply_keeps_positions(spark):
    df = spark.createDataFrame([(1, 2, 0.0), (1, 0, 1.0), (1, 1, None)], "request_id int, pos int, prediction double")
    row = requests.responses(df).first()
    assert (json.loads(row["response"]), row["n_items"]) == ([1.0, None, 0.0], 3)
    other = requests.result_responses(df.withColumn("prediction", F.col("prediction").cast("int"))).first()
    assert json.loads(other["response"]) == {"Results": ["1", None, "0"]}


def test_label_map_file(spark, tmp_path):
    df = spark.createDataFrame([("a", 0), ("b", 1)], "label string, idx bigint")
    save_label_map(df, str(tmp_path / "map"))
    assert sorted(load_label_map(spark, str(tmp_path / "map")).collect()) == sorted(df.collect())


def test_time_stamped_names(spark):
    df = spark.sql("SELECT timestamp'2024-03-05 14:07:09.123456' AS t")
    row = df.select(pipeline_name("Review-Labels", F.col("t")), deployment_name(F.col("t"))).first()
    assert tuple(row) == ("Review-Labels-2024-03-05-14-07-Pipeline", "deployment-03051407123456")


def test_parallel_writers_get_a_version_each(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    names = ["a/b c", "a/b c", "other"]

    def write(k):
        store = DatasetStore(spark, str(tmp_path))
        version = store.register(spark.range(k, k + 3).toDF("k"), names[k % 3], f"writer {k}")
        return names[k % 3], version, k

    with ThreadPoolExecutor(9) as pool:
        written = list(pool.map(write, range(9)))
    assert sorted((n, v) for n, v, _ in written) == [("a/b c", v) for v in range(1, 7)] + [("other", v) for v in range(1, 4)]
    store = DatasetStore(spark, str(tmp_path))
    assert sorted(tuple(r) for r in store.registry().collect()) == sorted((n, v, f"writer {k}", 3) for n, v, k in written)
    for name, version, k in written:
        assert sorted(r["k"] for r in store.read(name, version).collect()) == [k, k + 1, k + 2]
    assert store.latest_version("none") == 0 and store.registry().count() == 9
    with pytest.raises(LookupError):
        store.read("other", 4)


def test_a_taken_number_is_never_written_again(spark, tmp_path):
    from reviewloom.sources.manifests import entries, publish, put_if_absent

    path = f"{tmp_path}/v/0000000001.json"
    assert put_if_absent(spark, path, '{"a": 1, "version": 1}') and not put_if_absent(spark, path, '{"a": 2}')
    assert publish(spark, f"{tmp_path}/v", {"a": 3}) == 2 and publish(spark, f"{tmp_path}/v", {"a": 4}, first=9) == 9
    found = entries(spark, f"{tmp_path}/v", "a int, version int").collect()
    assert sorted(tuple(r) for r in found) == [(1, 1), (3, 2), (4, 9)]
    # A writer that died leaves a hidden file, which no reader takes for an entry.
    (tmp_path / "v" / ".left.tmp").write_text('{"a": 5')
    assert entries(spark, f"{tmp_path}/v", "a int, version int").count() == 3


def test_metrics_logged_as_text(spark):
    texts = ["0.5", " 2 ", "[0.25, 3]", "[]", "n/a", "", None, "1e3", "NaN", "[null]", '["x"]']
    cast = metric_log.cast_metrics(spark.createDataFrame([("m", t) for t in texts], "name string, value string"))
    rows = [(r["value"], r["rejected"]) for r in cast.collect()]
    assert rows[:8] == [(0.5, False), (2.0, False), (0.25, False), (None, True), (None, True), (None, True), (None, False), (1000.0, False)]
    assert rows[8][0] != rows[8][0] and rows[9:] == [(None, True), (None, True)]
    assert tuple(metric_log.cast_report(cast, ["name"]).first()) == ("m", 11, 1, 5)
