"""Boosted regression trees with a column subset per tree and ridge leaf values.

Each round draws its columns, grows one Spark regression tree on the residuals of its drawn rows,
and gives every leaf the value rate * G / (H + ridge), with G the sum of the residuals in the leaf
and H its rows. Rows are written with their predictions every few rounds, so plans stay short and a
lost executor costs those rounds. Rows flagged as validation are never trained on; their error is
known after every round and may end the fit.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueflow.functions.columns import clip
from venueflow.session import materialize


def drawn_columns(columns: Sequence[str], share: float, seed: int, round_: int) -> list[str]:
    """The columns of one round's tree, in their own order: a share of all, one at least."""
    n = max(1, min(len(columns), round(share * len(columns))))
    drawn = set(random.Random(f"{seed}:{round_}").sample(range(len(columns)), n))
    return [c for i, c in enumerate(columns) if i in drawn]


class ColumnSampledBoosting:
    """``rounds`` trees of ``depth``; ``columns`` and ``rows`` are the shares each tree sees.

    With ``validation`` (a boolean column) and ``patience``, the fit ends when the error of the
    flagged rows has not fallen for that many rounds, and keeps the trees up to the lowest error.
    """

    def __init__(
        self, rounds: int = 200, depth: int = 10, rate: float = 0.2, rows: float = 0.8, columns: float = 0.8, ridge: float = 1.0,
        seed: int = 3, validation: str | None = None, patience: int | None = None, write_every: int = 5,
    ):
        self.rounds, self.depth, self.rate, self.rows, self.columns, self.ridge = rounds, depth, rate, rows, columns, ridge
        self.seed, self.validation, self.patience, self.write_every = seed, validation, patience, write_every

    def _step(self, df: DataFrame, tree: tuple) -> DataFrame:
        slicer, model, values = tree
        out = model.transform(slicer.transform(df))
        value = F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("_leaf").cast("int") + 1)
        return out.withColumn("_f", F.col("_f") + value).select(*df.columns)

    def _grow(self, state: DataFrame, round_: int) -> tuple:
        drawn = drawn_columns(self.names, self.columns, self.seed, round_)
        slicer = VectorSlicer(inputCol="_all", outputCol="_some", indices=[self.names.index(c) for c in drawn])
        chance = F.pmod(F.xxhash64("_row", F.lit(round_), F.lit(self.seed)), F.lit(1 << 20)) < int(self.rows * (1 << 20))
        sampled = slicer.transform(state.filter(~F.col("_held") & chance).withColumn("_r", F.col("_y") - F.col("_f")))
        tree = DecisionTreeRegressor(featuresCol="_some", labelCol="_r", maxDepth=self.depth, leafCol="_leaf", predictionCol="_p", seed=self.seed)
        model = tree.fit(sampled)
        # At most 2^depth rows.
        sums = model.transform(sampled).groupBy(F.col("_leaf").cast("int").alias("leaf")).agg(F.sum("_r").alias("g"), F.count(F.lit(1)).alias("h")).collect()
        values = [0.0] * ((model.numNodes + 1) // 2)
        for s in sums:
            values[s["leaf"]] = self.rate * s["g"] / (s["h"] + self.ridge)
        return slicer, model, values

    def _errors(self, state: DataFrame) -> tuple[float | None, float | None]:
        square = F.pow(F.col("_y") - F.col("_f"), F.lit(2))
        return tuple(state.agg(F.sqrt(F.avg(F.when(~F.col("_held"), square))), F.sqrt(F.avg(F.when(F.col("_held"), square)))).first())

    def fit(self, train: DataFrame, columns: Sequence[str], target: str = "visitors") -> "ColumnSampledBoosting":
        self.names = list(columns)
        held = F.coalesce(F.col(self.validation), F.lit(False)) if self.validation else F.lit(False)
        rows = VectorAssembler(inputCols=self.names, outputCol="_all").transform(train)
        rows = rows.select("_all", F.log1p(F.col(target)).alias("_y"), held.alias("_held"), F.monotonically_increasing_id().alias("_row"))
        rows = materialize(rows, "boosting-rows")  # numbered once, so that draws of rows can be repeated
        self.base = rows.filter(~F.col("_held")).agg(F.avg("_y")).first()[0]
        if self.base is None:
            raise ValueError("no rows to train on")
        state = rows.withColumn("_f", F.lit(float(self.base)))
        self.trees: list[tuple] = []
        self.errors = [self._errors(state)]
        best = 0
        for i in range(1, self.rounds + 1):
            self.trees.append(self._grow(state, i))
            state = self._step(state, self.trees[-1])
            if i % self.write_every == 0:
                state = materialize(state, "boosting-rows")
            self.errors.append(self._errors(state))
            if self.patience is not None and self.errors[-1][1] is not None:
                best = min(range(len(self.errors)), key=lambda r: self.errors[r][1])
                if i - best >= self.patience:
                    break
        if self.patience is not None and self.errors[-1][1] is not None:
            self.trees = self.trees[:best]
        return self

    def scores_by_round(self, df: DataFrame) -> DataFrame:
        """(round, train_rmsle, validation_rmsle) of every round that was run; round 0 is the mean alone."""
        rows = [(i, *e) for i, e in enumerate(self.errors)]
        return df.sparkSession.createDataFrame(rows, "round int, train_rmsle double, validation_rmsle double")

    def tree_columns(self) -> list[list[str]]:
        """Columns each tree splits on."""
        out = []
        for slicer, model, _ in self.trees:
            used = [i for i, v in enumerate(model.featureImportances.toArray()) if v > 0]
            out.append([self.names[slicer.getIndices()[i]] for i in used])
        return out

    def predict_log(self, df: DataFrame, name: str, lower=None, upper=None) -> DataFrame:
        own = F.struct(*[F.col(c) for c in df.columns]).alias("_own")
        out = VectorAssembler(inputCols=self.names, outputCol="_all").transform(df).select(own, "_all", F.lit(float(self.base)).alias("_f"))
        for tree in self.trees:
            out = self._step(out, tree)
        return out.select(*[F.col("_own")[c].alias(c) for c in df.columns if c != name], clip("_f", lower, upper).alias(name))
