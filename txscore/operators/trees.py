"""A distributed decision tree (Spark ML) for surrogate rules: fitted on all rows, and so
shallow that its rules can be read. The tuned families are in ``ensembles``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame

SPARK_MAX_DEPTH = 30


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def decision_tree(max_depth: int = SPARK_MAX_DEPTH, impurity: str = "entropy", seed: int = 42,
                  min_instances: int = 1, label: str = "label") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol="features", impurity=impurity,
                                  maxDepth=min(max_depth, SPARK_MAX_DEPTH), minInstancesPerNode=min_instances,
                                  seed=seed, maxBins=64)


def fit_pipeline(train: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    return Pipeline(stages=[assembler(features), estimator]).fit(train)


# --- surrogate rules -------------------------------------------------------------

_NODE = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>|in|not in) ([^)]*)\)")
_LEAF = re.compile(r"^(\s*)Predict: ([0-9.]+)")


def tree_rules(tree_model, features: Sequence[str]) -> list[tuple[int, str, int]]:
    """(leaf_no, condition, class) from a fitted depth-limited tree, leaves in
    left-to-right order; conditions are conjunctions with feature names.

    Reads the model's debug text: one node per line, one extra space of indent
    per level below the root's two."""
    path: list[str] = []
    out: list[tuple[int, str, int]] = []
    for line in tree_model.toDebugString.splitlines()[1:]:
        level = len(line) - len(line.lstrip(" ")) - 2
        node = _NODE.match(line)
        if node:
            cond = f"{features[int(node.group(3))]} {node.group(4)} {node.group(5).strip()}"
            path = path[:level] + [cond]
            continue
        leaf = _LEAF.match(line)
        if leaf:
            out.append((len(out), " AND ".join(path[:level]) or "TRUE", int(float(leaf.group(2)))))
    return out
