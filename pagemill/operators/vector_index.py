"""Search for the nearest vectors by an inverted file that is kept as tables: lists around centres, with one byte a dimension for the residuals.

``codes`` holds (id, salt, code, err) partitioned by list, ``vectors`` the rows as they came; a batch of rows is a folder under its own name, so adding
it again replaces it. A search reads the lists nearest to its queries. ``err`` is the length of what a code leaves out, so a score from codes is off
by no more than that: a candidate whose upper bound reaches the query's k-th best lower bound is verified with its own vector. Within the lists read a
result is therefore exact, however many candidates that takes; with all lists it is exact altogether.

Vectors are compared by cosine. Those that are null, zero, of another length or hold null or non-finite components are found by no search, and such a query
finds nothing. Ids are the caller's: one id in two batches is two rows, found twice. Equal similarities are ranked by id.
"""

from __future__ import annotations

import collections
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.arrow import arrow_udf
from ..functions.scalars import cosine
from .search import bounded_sample, k_means

#: Rows that are read to learn centres (about, at most); sample rows a list needs; tasks that share a list; rows of the sample that measure recall.
SAMPLE, ROWS_A_LIST, SALTS, JUDGES = 20_000, 20, 8, 500
#: Rows (about) and queries (on average) that meet in one task at a time; queries of a product of matrices.
SLAB, QUERIES = 20_000, 256
#: Added to every bound, for what sums in another order may differ by.
SLACK = 1e-6


def usable(vector: Column | str) -> Column:
    """Whether a vector has a direction: no null or non-finite component, and not all zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _units(vectors) -> np.ndarray:
    v = np.stack([np.asarray(x, float) for x in vectors])
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as rows."""
    return column.combine_chunks().flatten().to_numpy().reshape(len(column), -1).astype(float)


def probes_for(units: np.ndarray, centres: np.ndarray, k: int, target: float) -> tuple[int, float]:
    """The fewest lists by which the first of the sample find ``target`` of their k nearest among the others, and what share they do find."""
    judges, others = units[:JUDGES], units[JUDGES:]
    if not len(others):
        return len(centres), 1.0
    own = (others @ centres.T).argmax(axis=1)
    place = np.argsort(np.argsort(-(judges @ centres.T), axis=1, kind="stable"), axis=1, kind="stable")
    k = min(k, len(others))
    near = np.argpartition(-(judges @ others.T), k - 1, axis=1)[:, :k]
    needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel()) + 1
    probes = int(needed[math.ceil(target * len(needed)) - 1])
    return probes, float((needed <= probes).mean())


class VectorIndex:
    """The index under a folder. ``train`` once, then ``add`` batches; any session may open it for more batches or searches."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._model = None

    def train(self, rows: DataFrame, lists: int | None = None, k: int = 10, target: float = 0.95, sample: int = SAMPLE, id_col: str = "id", vector_col: str = "embedding") -> None:
        """Learns centres, steps of the codes and the number of lists to read, from a bounded sample that covers all rows by a hash of their ids.

        The index is for vectors of the length that is most frequent there. Without ``lists`` there are as many as the root of the number of rows,
        but no more than the sample can place.
        """
        fit = rows.where(usable(vector_col)).select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
        n, taken = bounded_sample(fit, "id", sample)
        if not taken:
            raise ValueError("no vector to learn from")
        lengths = collections.Counter(len(r.embedding) for r in taken)
        width = max(lengths, key=lambda x: (lengths[x], x))
        units = _units([r.embedding for r in taken if len(r.embedding) == width])
        most = max(1, len(units) // ROWS_A_LIST)
        centres = k_means(units, lists or min(most, math.isqrt(n)) or 1)
        left = units - centres[(units @ centres.T).argmax(axis=1)]
        steps = np.maximum(np.abs(left).max(axis=0), 1e-6) / 127
        probes, recall = probes_for(units, centres, k, target)
        model = [("centre", i, float("nan"), c.tolist()) for i, c in enumerate(centres)] + [("steps", 0, recall, steps.tolist()), ("probes", probes, recall, [])]
        self.spark.createDataFrame(model, "part string, number int, recall double, vector array<double>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/model")
        self._model = None

    @property
    def model(self) -> tuple[np.ndarray, np.ndarray, int, float]:
        """Centres, steps, lists to read, and the recall that these had on the sample."""
        if self._model is None:
            rows = self.spark.read.parquet(f"{self.path}/model").collect()  # a row per list
            centres = np.array([r.vector for r in sorted((r for r in rows if r.part == "centre"), key=lambda r: r.number)])
            probes = next(r for r in rows if r.part == "probes")
            self._model = centres, np.array(next(r.vector for r in rows if r.part == "steps")), probes.number, probes.recall
        return self._model

    def add(self, rows: DataFrame, batch: str, id_col: str = "id", vector_col: str = "embedding") -> None:
        """Adds rows under a batch's name; a list's rows are dealt out by id, so none is a single task."""
        centres, steps, _, _ = self.model
        width = centres.shape[1]

        @arrow_udf("list_id int, code array<tinyint>, err double", once=True)
        def encode(vectors: pd.Series) -> pd.DataFrame:
            if not len(vectors):
                return pd.DataFrame({"list_id": [], "code": [], "err": []})
            units = _units(vectors)
            own = (units @ centres.T).argmax(axis=1)
            left = units - centres[own]
            codes = np.clip(np.rint(left / steps), -127, 127)
            return pd.DataFrame({"list_id": own.astype("int32"), "code": list(codes.astype("int8")), "err": np.linalg.norm(left - codes * steps, axis=1) + SLACK})

        fit = rows.where((F.size(vector_col) == width) & usable(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("embedding"))
        fit.write.mode("overwrite").parquet(f"{self.path}/vectors/batch={batch}")
        stored = self.spark.read.parquet(f"{self.path}/vectors/batch={batch}").where(usable("embedding")).withColumn("_e", encode("embedding"))
        coded = stored.select("id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"), "_e.code", "_e.err", "_e.list_id")
        coded.repartitionByRange("list_id", "salt", "id").sortWithinPartitions("list_id").write.mode("overwrite").partitionBy("list_id").parquet(f"{self.path}/codes/batch={batch}")

    def table(self, name: str) -> DataFrame:
        schema = "id long, salt int, code array<tinyint>, err double, batch string, list_id int" if name == "codes" else "id long, embedding array<float>, batch string"
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(f"{self.path}/{name}")

    def nearest_lists(self, queries: DataFrame, probes: int, id_col: str, vector_col: str) -> DataFrame:
        """A row per query: (query_id, unit, lists), its direction and the lists it reads."""
        centres = self.model[0]

        @arrow_udf("unit array<double>, lists array<int>", once=True)
        def near(vectors: pd.Series) -> pd.DataFrame:
            if not len(vectors):
                return pd.DataFrame({"unit": [], "lists": []})
            units = _units(vectors)
            first = np.argsort(-(units @ centres.T), axis=1, kind="stable")[:, :probes]
            return pd.DataFrame({"unit": list(units), "lists": list(first.astype("int32"))})

        fit = queries.where((F.size(vector_col) == centres.shape[1]) & usable(vector_col)).withColumn("_n", near(vector_col))
        return fit.select(F.col(id_col).alias("query_id"), "_n.unit", "_n.lists")

    def codes_of(self, wanted: DataFrame) -> DataFrame:
        """Codes of the lists that queries (lists) read, by a filter on the partitions."""
        lists = [r.l for r in wanted.select(F.explode("lists").alias("l")).distinct().collect()]  # no more than there are centres
        return self.table("codes").where(F.col("list_id").isin(lists) if lists else F.lit(False))

    def likely(self, near: DataFrame, k: int) -> DataFrame:
        """(query_id, id, batch) of all codes that may be among a query's k nearest in its lists.

        Codes are dealt out into slabs of whole lists, or of salts of large ones, and a query goes once to each slab that holds a list of its own. There the
        scores are products of matrices, and what k others of the slab are sure to beat stays there; so slabs grow in number with the rows, and
        what they send on with the queries.
        """
        centres, steps, _, _ = self.model
        codes, queries = self.codes_of(near), near.count()
        groups = max(1, math.ceil(codes.count() / SLAB))
        salts = min(SALTS, math.ceil(groups / len(centres)))
        groups, parts = min(groups, len(centres)), max(1, math.ceil(queries / SLAB))

        def meet(key: tuple, asked: pa.Table, stored: pa.Table) -> pa.Table:
            out = []
            if asked.num_rows and stored.num_rows:
                own = stored["list_id"].to_numpy()
                known = centres[own] + _matrix(stored["code"]) * steps
                err = stored["err"].to_numpy()
                units, lists = _matrix(asked["unit"]), asked["lists"].combine_chunks()
                reads = np.zeros((asked.num_rows, len(centres)), bool)
                reads[np.repeat(np.arange(asked.num_rows), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()] = True
                for first in range(0, asked.num_rows, QUERIES):
                    score = np.where(reads[first : first + QUERIES][:, own], units[first : first + QUERIES] @ known.T, -np.inf)
                    low = score - err
                    least = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
                    row, col = np.nonzero((score + err >= least[:, None]) & (score > -np.inf))
                    out.append(pa.table({"query_id": asked["query_id"].take(pa.array(row + first)), "id": stored["id"].take(pa.array(col)), "batch": stored["batch"].take(pa.array(col)), "score": score[row, col], "err": err[col]}))
            return pa.concat_tables(out) if out else pa.table({n: pa.array([], t) for n, t in (("query_id", asked.schema.field("query_id").type), ("id", pa.int64()), ("batch", pa.string()), ("score", pa.float64()), ("err", pa.float64()))})

        slab = F.expr(f"list_id % {groups}")
        stored = codes.select(slab.alias("slab"), F.expr(f"salt % {salts}").cast("int").alias("salt"), "list_id", "id", "batch", "code", "err", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        asked = near.withColumns({"slab": F.explode(F.array_distinct(F.transform("lists", lambda x: x % groups))), "part": F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")})
        asked = asked.withColumns({"salt": F.explode(F.sequence(F.lit(0), F.lit(salts - 1))), "lists": F.filter("lists", lambda x: x % groups == F.col("slab"))})
        keys, kind = ["slab", "salt", "part"], near.schema["query_id"].dataType.simpleString()
        met = asked.select(*keys, "query_id", "unit", "lists").groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInArrow(meet, f"query_id {kind}, id long, batch string, score double, err double")
        met = met.persist(StorageLevel.DISK_ONLY)
        low = met.select("query_id", (F.col("score") - F.col("err")).alias("low"))
        kth = low.withColumn("_r", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low")))).where(F.col("_r") <= k).groupBy("query_id").agg(F.min("low").alias("least"))
        return met.join(kth, "query_id").where(F.col("score") + F.col("err") >= F.col("least")).select("query_id", "id", "batch")

    def search(self, queries: DataFrame, k: int = 10, probes: int | None = None, id_col: str = "query_id", vector_col: str = "embedding") -> DataFrame:
        """(query id, id, similarity) of the k nearest rows in the lists read; any number of queries is one join. ``probes``: lists a query reads, else as trained."""
        near = self.nearest_lists(queries, probes or self.model[2], id_col, vector_col)
        asked = queries.select(F.col(id_col).alias("query_id"), F.col(vector_col).alias("_q"))
        found = self.likely(near, k).join(self.table("vectors"), ["id", "batch"]).join(asked, "query_id").select("query_id", "id", cosine("embedding", "_q").alias("similarity"))
        best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
        return found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k).select(F.col("query_id").alias(id_col), "id", "similarity")
