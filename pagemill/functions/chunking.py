"""Markdown chunks for embedding, and the embedding of chunks."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import PAGES, arrow_udf

MOST_CHARS, LEAST_CHARS, MOST_CHUNKS, LEAST_MARKDOWN = 500, 50, 20, 200
_heading = re.compile(r"^(#{1,6})\s+(.+)$", re.MULTILINE)


def sections(text: str) -> Iterator[tuple[str, str]]:
    """(body, path of headings) of the parts between headings; headings inside code count, empty parts do not."""
    body, *rest = _heading.split(text)
    titles: list[str | None] = [None] * 6  # the open heading of each level
    parts = [(body, "")]
    for marks, title, body in zip(rest[::3], rest[1::3], rest[2::3], strict=True):
        level = len(marks)
        titles[level - 1 :] = [title.strip()] + [None] * (6 - level)
        parts.append((body, " > ".join(t for t in titles if t is not None)))
    yield from ((body.strip(), path) for body, path in parts if body.strip())


def gather(parts: list[str], glue: str, most: int) -> Iterator[str]:
    """Neighbouring parts joined while they fit; a part that is too long ends the run and stands alone."""
    held = ""
    for part in parts:
        if held and len(held) + len(part) + len(glue) <= most:
            held = (held + glue + part).strip()
            continue
        if held:
            yield held.strip()
        held = ""
        if len(part) > most:
            yield part
        else:
            held = part
    if held:
        yield held.strip()


def section_chunks(text: str, most: int) -> list[str]:
    """Paragraphs, then sentences, then cuts of ``most`` characters, as large as they fit."""
    if len(text) <= most:
        return [text]
    out = []
    for piece in gather([p for x in re.split(r"\n\n+", text) if (p := x.strip())], "\n\n", most):
        if len(piece) <= most:
            out.append(piece)
            continue
        for sentence in gather(re.split(r"(?<=[.!?])\s+", piece), " ", most):
            out += [sentence[i : i + most] for i in range(0, len(sentence), most)]
    return out


def chunks(text: str | None, most: int = MOST_CHARS, least: int = LEAST_CHARS) -> list[dict]:
    """Chunks (text, heading_ctx, chunk_index) of a document.

    A chunk under ``least`` takes in the next one under its own headings, even of another section; the last
    folds back. Blanks at a cut between words stay where chunks are joined; only the ends of a chunk are stripped. Numbers are given before blank chunks are left out.
    """
    if not text or not text.strip():
        return []
    merged: list[list[str]] = []
    for body, path in sections(text):
        for piece in section_chunks(body, most):
            if merged and len(merged[-1][0]) < least:
                merged[-1][0] += "\n\n" + piece
            else:
                merged.append([piece, path])
    if len(merged) > 1 and len(merged[-1][0]) < least:
        last = merged.pop()[0]
        merged[-1][0] += "\n\n" + last
    return [{"text": t.strip(), "heading_ctx": c, "chunk_index": i} for i, (t, c) in enumerate(merged) if t.strip()]


@arrow_udf("array<struct<text:string,heading_ctx:string,chunk_index:int>>", once=True, most=PAGES)
def _chunks(text: pd.Series) -> pd.Series:
    return text.map(chunks)


def chunk_rows(docs: DataFrame, url: str = "url", markdown: str = "markdown", most_chunks: int | None = MOST_CHUNKS, least: int = LEAST_MARKDOWN, success: str | None = None) -> DataFrame:
    """One row per chunk (url, chunk_index, chunk_text, heading_ctx): eligible documents, their first ``most_chunks``, with None all.

    A document needs a URL and ``least`` characters of Markdown, and success where that is known.
    """
    ok = (F.coalesce(F.col(url).cast("string"), F.lit("")) != "") & (F.length(markdown) >= least)
    rows = docs.where(ok & F.col(success) if success else ok).withColumn("_c", _chunks(markdown))
    found = F.col("_c") if most_chunks is None else F.slice("_c", 1, most_chunks)
    return rows.select(F.col(url).alias("url"), F.explode(found).alias("c")).select("url", "c.chunk_index", F.col("c.text").alias("chunk_text"), "c.heading_ctx")


class HashEmbedder:
    """A deterministic embedder that needs no model: signed hashes of words, unit length."""

    model = "hash"

    def __init__(self, dimension: int = 384):
        self.dimension = dimension

    def embed_batch(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimension), np.float32)
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little")
                out[i, h % self.dimension] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm == 0, 1, norm)


class RemoteEmbedder:
    """Vectors of a service that takes {model, input: [texts]} and answers {data: [{embedding}]}; a batch of texts a request.

    ``post`` sends a JSON body and gives the decoded answer; the standard library does it if none is given.
    """

    def __init__(self, url: str, model: str, key: str = "", dimension: int = 1536, batch: int = 64, post: Callable[[str, dict, dict], dict] | None = None):
        self.url, self.model, self.key, self.dimension, self.batch, self.post = url, model, key, dimension, batch, post or _post

    def embed_batch(self, texts: list[str]) -> np.ndarray:
        out: list[list[float]] = []
        for i in range(0, len(texts), self.batch):
            part = texts[i : i + self.batch]
            data = self.post(self.url, {"model": self.model, "input": part}, {"Authorization": f"Bearer {self.key}"})["data"]
            if len(data) != len(part) or any(len(x["embedding"]) != self.dimension for x in data):
                raise ValueError("the service's answer has another shape than was asked for")
            out += [x["embedding"] for x in data]
        return np.asarray(out, np.float32).reshape(len(texts), self.dimension)


def _post(url: str, body: dict, headers: dict) -> dict:
    from urllib.request import Request, urlopen

    request = Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", **headers})
    with urlopen(request, timeout=60) as answer:
        return json.load(answer)


EMBEDDERS = {"local": HashEmbedder, "hash": HashEmbedder, "remote": RemoteEmbedder}


def create_embedder(kind: str | None = None, **options):
    """An embedder by name; an unknown name gives the local one."""
    return EMBEDDERS.get((kind or "local").lower(), EMBEDDERS["local"])(**options)


def embedding(text: Column | str, embedder=None) -> Column:
    """Vectors of a text column; the embedder is made once a task."""
    make = embedder or create_embedder()

    @F.pandas_udf("array<float>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(make.embed_batch([t or "" for t in batch])), index=batch.index)

    return run(text)
