"""Cover trees over norm-augmented vectors, for exact windows of inner products.

Vectors get one more coordinate, so that all have the norm of the longest: x' = (x, sqrt(M^2 - |x|^2)). On that
sphere an inner product with a query (augmented by 0) is |q| M times the cosine of an angle. A level of the tree
covers its points by balls of one radius, half that of the level above, whose centres are points farther apart
than that radius; a node's covering angle then bounds every inner product below it from both sides. Points that
no other point is near at a level hang on the node above, as do the last few of a node: these are its bucket.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEAF_ROWS = 32
NODES_AT_ONCE = 16
# Parts of |q| M by which bounds are widened; angles are good to about 1e-8.
SLACK = 1e-6
EXACT = 2.0**53


def narrow(x: np.ndarray) -> np.ndarray:
    """Whole doubles in the smallest kind that holds them."""
    most = np.abs(x).max(initial=0)
    return x.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def padded(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])))


@dataclass
class Window:
    """The ``k`` best scores from ``low`` to ``high``; ``low`` rises as better ones are found."""

    low: int
    high: int
    k: int
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float64))

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fits = (scores >= self.low) & (scores <= self.high)
        if not fits.any():
            return
        ids, scores = np.concatenate([self.ids, ids[fits]]), np.concatenate([self.scores, scores[fits]])
        best = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[best], scores[best]
        if len(best) == self.k:
            self.low = max(self.low, int(self.scores[-1]))


def bounds(cosine_mass: np.ndarray, size: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product below nodes: centre's product, |q| M, and covering angle of each."""
    with np.errstate(divide="ignore", invalid="ignore"):
        theta = np.arccos(np.clip(np.where(size > 0, cosine_mass / size, 1.0), -1, 1))
    room = SLACK * size + 1
    return size * np.cos(np.minimum(theta + angle, np.pi)) - room, size * np.cos(np.maximum(theta - angle, 0)) + room


@dataclass
class Tree:
    """Nodes in level order; points in the order of the buckets that hold them, each in exactly one."""

    ids: np.ndarray
    codes: np.ndarray
    labels: list[str]
    points: np.ndarray
    mass: float
    centre: np.ndarray
    angle: np.ndarray
    children: np.ndarray
    bucket: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def search(self, query_id: int, query: np.ndarray, label: str, same: bool, windows: list[Window]) -> None:
        """Fills ``windows`` with rows of the query's label, or of others, never with the query's own id."""
        width = max(len(query), self.points.shape[1])
        query = np.pad(query, (0, width - len(query)))
        points = self.points if self.points.shape[1] == width else padded(self.points, width)
        code = self.labels.index(label) if label in self.labels else -1
        size = float(np.sqrt(query @ query)) * self.mass
        exact = size < EXACT
        whole = None if exact else [int(x) for x in query]

        def open_nodes(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            if same:
                nodes = nodes[(self.least[nodes] <= code) & (code <= self.most[nodes])]
            else:
                nodes = nodes[(self.least[nodes] != code) | (self.most[nodes] != code)]
            near = points[self.centre[nodes]].astype(np.float64) @ query
            return nodes, *bounds(near, np.full(len(nodes), size), self.angle[nodes])

        nodes, low, high = open_nodes(np.zeros(1, np.int64))
        while len(nodes):
            wanted = np.zeros(len(nodes), bool)
            for w in windows:
                wanted |= (high >= w.low) & (low <= w.high)
            nodes, low, high = nodes[wanted], low[wanted], high[wanted]
            if not len(nodes):
                return
            best = np.argsort(-high)
            now, later = best[:NODES_AT_ONCE], best[NODES_AT_ONCE:]
            rows = np.concatenate([np.arange(a, b) for a, b in self.bucket[nodes[now]]])
            rows = rows[((self.codes[rows] == code) == same) & (self.ids[rows] != query_id)]
            if len(rows):
                if exact:
                    scores = points[rows].astype(np.float64) @ query
                else:
                    scores = np.array([sum(int(a) * b for a, b in zip(x, whole)) for x in points[rows].tolist()], object)
                for w in windows:
                    w.add(self.ids[rows], scores)
            below = np.concatenate([np.arange(a, b) for a, b in self.children[nodes[now]]])
            more, more_low, more_high = open_nodes(below)
            nodes = np.concatenate([nodes[later], more])
            low, high = np.concatenate([low[later], more_low]), np.concatenate([high[later], more_high])


def build(ids: np.ndarray, labels: list[str], points: np.ndarray) -> Tree:
    """A tree of points (whole doubles, rows by dimensions)."""
    names, codes = np.unique(np.array(labels, object).astype(str), return_inverse=True)
    square = (points * points).sum(axis=1)
    mass = float(np.sqrt(square.max(initial=0)))
    unit = np.column_stack([points, np.sqrt(np.maximum(mass * mass - square, 0))]) / (mass or 1.0)

    def chords(centre: int, members: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 - 2 * (unit[members] @ unit[centre]), 0)) if mass else np.zeros(len(members))

    first = np.arange(len(ids))
    queue = [(0, first, chords(0, first), float("inf"))]
    order: list[np.ndarray] = []
    at, placed = 0, 0
    centre, angle, children, bucket, least, most = [], [], [], [], [], []
    while at < len(queue):
        middle, members, far, radius = queue[at]
        reach = float(far.max(initial=0))
        centre.append(middle)
        angle.append(2 * np.arcsin(min(reach / 2, 1.0)) + SLACK)
        least.append(codes[members].min())
        most.append(codes[members].max())
        begin = len(queue)
        hanging = members
        if len(members) > LEAF_ROWS and reach > 2 * SLACK:
            # The next level that splits this ball; levels halve the first one's radius.
            radius = min(radius, 2.0)
            while radius >= reach:
                radius /= 2
            loose = []
            rest, rest_far, own, own_far = members, far, middle, far
            while True:
                covered = own_far <= radius
                if covered.sum() > LEAF_ROWS // 8:
                    queue.append((own, rest[covered], own_far[covered], radius / 2))
                else:
                    loose.append(rest[covered])
                rest, rest_far = rest[~covered], rest_far[~covered]
                if not len(rest):
                    break
                own = int(rest[rest_far.argmax()])
                own_far = chords(own, rest)
                own_far[rest == own] = 0.0
            hanging = np.concatenate(loose) if loose else members[:0]
        children.append((begin, len(queue)))
        bucket.append((placed, placed + len(hanging)))
        order.append(hanging)
        placed += len(hanging)
        at += 1
    places = np.concatenate(order)
    back = np.empty(len(places), np.int64)
    back[places] = np.arange(len(places))
    return Tree(
        ids[places], codes[places], names.tolist(), narrow(points[places]), mass, back[np.array(centre)], np.array(angle),
        np.array(children), np.array(bucket), np.array(least), np.array(most),
    )
