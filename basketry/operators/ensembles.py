"""Fitted trees as plain data: scoring as one SQL projection, tables on disk, boxes of leaves."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession

_SCHEMA = (
    "tree int, node int, feature string, cut double, left int, right int, value double, cover double, "
    "inclusive boolean, base double, features string"
)


# Nodes up to which a forecast is nested conditions in SQL. More are walked in arrays: the code generated for
# tens of thousands of conditions is longer than the JVM takes.
MOST_CONDITIONS = 2_000


@dataclass(frozen=True)
class Node:
    """A split (rows with ``feature`` below ``cut`` go left) or, without a feature, a leaf."""

    value: float
    cover: float
    feature: str | None = None
    cut: float | None = None
    left: int = -1
    right: int = -1


@dataclass(frozen=True)
class Leaf:
    """A leaf as a box: for each feature on its path (low, high, share of cover that stays inside)."""

    value: float
    sides: dict[str, tuple[float, float, float]]


@dataclass(frozen=True)
class Ensemble:
    """``base`` plus the sum of the trees, whose first nodes are their roots.

    ``inclusive`` tells on which side a value equal to the cut goes: left if true.
    """

    features: tuple[str, ...]
    trees: tuple[tuple[Node, ...], ...]
    base: float = 0.0
    inclusive: bool = False

    def expression(self) -> str:
        """The forecast in SQL. Sums are nested in pairs, so hundreds of trees stay shallow."""
        if sum(map(len, self.trees)) > MOST_CONDITIONS:
            return self._walk()
        terms = [self.tree_expression(t) for t in range(len(self.trees))]
        while len(terms) > 1:
            terms = [f"({'+'.join(terms[i : i + 2])})" for i in range(0, len(terms), 2)]
        return f"({self.base!r}D+{terms[0]})" if terms else f"{self.base!r}D"

    def tree_expression(self, tree: int) -> str:
        nodes = self.trees[tree]
        sign = "<=" if self.inclusive else "<"

        def of(at: int) -> str:
            node = nodes[at]
            if node.feature is None:
                return f"{node.value!r}D"
            return f"if(`{node.feature}`{sign}{node.cut!r}D,{of(node.left)},{of(node.right)})"

        return of(0)

    def _walk(self) -> str:
        """The forecast as a walk down each tree; a leaf leads to itself. The arrays are folded to literals."""
        sign = "<=" if self.inclusive else "<"
        features, cuts, low, high, values, roots = [], [], [], [], [], []
        for nodes in self.trees:
            start = len(values)
            roots.append(start)
            for at, node in enumerate(nodes):
                leaf = node.feature is None
                features.append(0 if leaf else self.features.index(node.feature))
                cuts.append(0.0 if leaf else node.cut)
                low.append(start + (at if leaf else node.left))
                high.append(start + (at if leaf else node.right))
                values.append(node.value)

        def listed(items: list, kind: str) -> str:
            return f"from_json('{json.dumps(items)}', 'array<{kind}>')"

        row = ", ".join(f"CAST(`{c}` AS DOUBLE)" for c in self.features)
        below = f"row[{listed(features, 'int')}[node]] {sign} {listed(cuts, 'double')}[node]"
        step = f"if({below}, {listed(low, 'int')}[node], {listed(high, 'int')}[node])"
        deepest = max(_depth(nodes, 0) for nodes in self.trees)
        leaf = f"aggregate({listed(list(range(deepest)), 'int')}, root, (node, _) -> {step})"
        total = f"aggregate({listed(roots, 'int')}, {self.base!r}D, (total, root) -> total + {listed(values, 'double')}[{leaf}])"
        return f"transform(array(array({row})), row -> {total})[0]"

    def pipeline(self) -> PipelineModel:
        """The forecast as ``prediction``, to be saved, loaded and used like any fitted model."""
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {self.expression()} AS prediction FROM __THIS__")])

    def leaves(self) -> Iterator[Leaf]:
        for nodes in self.trees:
            yield from _boxes(nodes, 0, {})

    def table(self, spark: SparkSession) -> DataFrame:
        """A row for each node."""
        names = json.dumps(list(self.features))
        rows = [
            (t, k, n.feature, n.cut, n.left, n.right, n.value, n.cover, self.inclusive, self.base, names)
            for t, nodes in enumerate(self.trees)
            for k, n in enumerate(nodes)
        ]
        return spark.createDataFrame(rows, _SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Ensemble:
        rows = spark.read.parquet(path).orderBy("tree", "node").collect()
        trees: list[list[Node]] = []
        for r in rows:
            if r["node"] == 0:
                trees.append([])
            trees[-1].append(Node(r["value"], r["cover"], r["feature"], r["cut"], r["left"], r["right"]))
        if not rows:
            raise ValueError(f"no trees in {path}")
        features = tuple(json.loads(rows[0]["features"]))
        return cls(features, tuple(map(tuple, trees)), rows[0]["base"], rows[0]["inclusive"])


def _depth(nodes: Sequence[Node], at: int) -> int:
    node = nodes[at]
    return 0 if node.feature is None else 1 + max(_depth(nodes, node.left), _depth(nodes, node.right))


def _boxes(nodes: Sequence[Node], at: int, sides: dict) -> Iterator[Leaf]:
    node = nodes[at]
    if node.feature is None:
        yield Leaf(node.value, sides)
        return
    low, high, share = sides.get(node.feature, (-math.inf, math.inf, 1.0))
    for child, (a, b) in ((node.left, (low, min(high, node.cut))), (node.right, (max(low, node.cut), high))):
        part = nodes[child].cover / node.cover if node.cover else 0.0
        yield from _boxes(nodes, child, {**sides, node.feature: (a, b, share * part)})
