"""Time-stamped names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two name formats. The second has microseconds but no seconds.
PIPELINE_STAMP = "yyyy-MM-dd-HH-mm"
DEPLOYMENT_STAMP = "MMddHHmmSSSSSS"


def pipeline_name(title: Column | str, created: Column) -> Column:
    head = F.lit(title) if isinstance(title, str) else title
    return F.concat(head, F.lit("-"), F.date_format(created, PIPELINE_STAMP), F.lit("-Pipeline"))


def deployment_name(created: Column) -> Column:
    return F.concat(F.lit("deployment-"), F.date_format(created, DEPLOYMENT_STAMP))
