"""Vector search over page chunks, chunk lookup, and the context built from results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import cosine

#: Limits and defaults of the search interface.
TOP_K, MIN_SIMILARITY, MOST_K, CONTEXT_CHARS = 5, 0.3, 50, 4000


def check_dimension(chunks: DataFrame, expected: int | None) -> None:
    """Raises if vectors have another length than expected; an unknown length is let pass."""
    if expected is None:
        return
    wrong = chunks.where(F.col("embedding").isNotNull() & (F.size("embedding") != expected)).limit(1).count()
    if wrong:
        raise ValueError(f"vectors are not of dimension {expected}")


def search_view(chunks: DataFrame, pages: DataFrame) -> DataFrame:
    """Chunks with the metadata of their pages; chunks of unknown pages stay."""
    p = pages.select("url", "title", "domain", "language", "crawled_at")
    return chunks.where("embedding is not null").join(p, "url", "left")


def search(chunks: DataFrame, pages: DataFrame, query: list[float], top_k: int = TOP_K, min_similarity: float = MIN_SIMILARITY, domain: str | None = None) -> DataFrame:
    """The ``top_k`` most similar chunks, best first, ties by url and index.

    Without a domain the pages join after the top-k, for a handful of rows; with one they filter first.
    """
    if not 1 <= top_k <= MOST_K:
        raise ValueError(f"top_k must be 1 to {MOST_K}")
    q = F.array(*[F.lit(float(x)) for x in query])
    scored = chunks.withColumn("similarity", cosine("embedding", q)).where(F.col("similarity") >= min_similarity)
    p = pages.select("url", "title", "domain", "language", "crawled_at")
    best = [F.desc("similarity"), F.col("url"), F.col("chunk_index")]
    if domain is None:
        out = scored.orderBy(*best).limit(top_k).join(p, "url", "left")
    else:
        out = scored.join(p.where(F.col("domain") == domain), "url").orderBy(*best).limit(top_k)
    return out.select("url", "title", "domain", "chunk_text", "heading_ctx", "chunk_index", F.round("similarity", 4).alias("similarity"), "language", "crawled_at")


def chunks_of(chunks: DataFrame, pages: DataFrame, url: str) -> DataFrame:
    """All chunks of a page in order; empty if there is none."""
    p = pages.select("url", "title", "domain", "language", "crawled_at")
    return chunks.where(F.col("url") == url).join(p, "url", "left").orderBy("chunk_index").select("url", "title", "domain", "chunk_index", "chunk_text", "heading_ctx")


def _header(rank: Column) -> Column:
    place = F.when(F.coalesce("heading_ctx", F.lit("")) != "", F.concat("heading_ctx", F.lit(" "))).otherwise("")
    title = F.when(F.coalesce("title", F.lit("")) != "", F.col("title")).otherwise("제목 없음")
    return F.concat(F.lit("["), rank, F.lit("] "), title, F.lit(" ("), F.coalesce("domain", F.lit("")), F.lit(")\nURL: "), "url", F.lit("\n위치: "), place, F.lit("(유사도: "), F.format_string("%.2f", "similarity"), F.lit(")"))


def context_sections(results: DataFrame, most: int = CONTEXT_CHARS) -> DataFrame:
    """The sections (rank, section) that fit the budget: whole ones, then one cut short if over 100 characters are left.

    ``results`` is a search result, at most ``MOST_K`` rows.
    """
    one = Window.partitionBy(F.lit(1))
    rank = F.row_number().over(one.orderBy(F.desc("similarity"), "url", "chunk_index"))
    r = results.withColumn("rank", rank).withColumn("header", _header(F.col("rank"))).withColumn("section", F.concat("header", F.lit("\n\n"), "chunk_text"))
    upto = F.sum(F.length("section")).over(one.orderBy("rank"))
    r = r.withColumn("before", upto - F.length("section")).withColumn("over", upto > most)
    first = F.min(F.when(F.col("over"), F.col("rank"))).over(one)
    room = F.lit(most) - F.col("before") - F.length("header") - 10
    cut = F.concat("header", F.lit("\n\n"), F.expr("substring(chunk_text, 1, room)"), F.lit("..."))
    r = r.withColumn("first_over", first).withColumn("room", room.cast("int"))
    return r.where((F.col("first_over").isNull()) | (F.col("rank") < F.col("first_over")) | ((F.col("rank") == F.col("first_over")) & (F.col("room") > 100))).select("rank", F.when(F.col("over"), cut).otherwise(F.col("section")).alias("section"))


def format_context(results: DataFrame, most: int = CONTEXT_CHARS) -> DataFrame:
    """One row with the whole context; a fixed sentence if nothing was found."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("rank", "section"))), lambda s: s["section"])
    return context_sections(results, most).agg(F.when(F.size(parts) == 0, "관련 문서를 찾을 수 없습니다.").otherwise(F.array_join(parts, "\n\n---\n\n")).alias("context"))


def assign_lists(chunks: DataFrame, centres: list[list[float]]) -> DataFrame:
    """Chunks with the number of their nearest centre (``list_id``): written partitioned by it, an inverted file."""
    near = F.array(*[F.struct(cosine("embedding", F.array(*[F.lit(float(x)) for x in c])).alias("s"), F.lit(-i).alias("i")) for i, c in enumerate(centres)])
    return chunks.withColumn("list_id", -F.array_max(near)["i"])


def probe(chunks: DataFrame, centres: list[list[float]], query: list[float], probes: int = 10) -> DataFrame:
    """Chunks of the ``probes`` lists nearest to the query: a pruning predicate on ``list_id``."""
    import numpy as np

    c, q = np.asarray(centres, float), np.asarray(query, float)
    near = np.argsort(-(c @ q) / np.linalg.norm(c, axis=1), kind="stable")[:probes]
    return chunks.where(F.col("list_id").isin([int(i) for i in near]))


def bounded_sample(rows: DataFrame, key: str, most: int) -> tuple[int, list]:
    """The number of rows, and all of them or, of more, about ``most``, chosen and ordered by a hash of the key: a filter before anything is gathered."""
    n = rows.count()
    share = F.pmod(F.xxhash64(key), F.lit(1_000_000_007)) < int(most / n * 1_000_000_007) if n > most else F.lit(True)
    return n, rows.where(share).orderBy(F.xxhash64(key)).collect()


def k_means(units, lists: int, turns: int = 10):
    """Centres of unit vectors, of length one too; a centre that loses all its vectors stays."""
    import numpy as np

    c = units[np.linspace(0, len(units) - 1, min(lists, len(units))).astype(int)]
    for _ in range(turns):
        own = (units @ c.T).argmax(axis=1)
        c = np.stack([units[own == k].mean(axis=0) if (own == k).any() else c[k] for k in range(len(c))])
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def learn_centres(chunks: DataFrame, lists: int = 100, sample: int = 20000, turns: int = 10) -> list[list[float]]:
    """Centres by k-means on a bounded sample of unit vectors."""
    import numpy as np

    _, rows = bounded_sample(chunks.where("embedding is not null").select("id", "embedding"), "id", sample)
    v = np.array([r.embedding for r in rows], float)
    return k_means(v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12), lists, turns).tolist()
