"""Language identification of mixed-language text.

Each word gets a score per language from hashed trigrams of its letters. Script ranges narrow the
candidates: a language that is not written in a word's script is none for that word. Viterbi over the
words of a text, with a penalty for each switch, labels its spans; the text's language is the one
with most letters.

The model is fitted on a bounded sample of the labelled rows (``FIT_ROWS``); texts are labelled whole,
where they are read, in pieces of bounded memory. Nothing but the sample is shuffled.
"""

from __future__ import annotations

import sys
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, flat_bytes, row_blocks, sampled, schema_of

#: Labelled rows to fit on, at most; partitions that count them; hash buckets of trigrams.
FIT_ROWS, FIT_PARTS, BUCKETS = 20_000, 12, 1 << 16
#: Languages a model holds at most; more labels are taken for a mistake.
MOST_LANGS = 1000
#: Cost of a switch between words, in log units; characters and bytes of texts handled at once.
PENALTY, PIECE, BATCH_BYTES = 12.0, 1 << 19, 8 << 20
UNKNOWN = -40.0

#: Where the blocks of scripts begin, in order of code points, and their names.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "southeast"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "ethiopic"), (0x13A0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "kana"), (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x323B0, "other"),
)
SCRIPT_NAMES = sorted({n for _, n in SCRIPTS})

_tables: list[tuple[np.ndarray, np.ndarray]] = []


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """Whether each code point is a letter, and the number of its script."""
    if not _tables:
        points = range(sys.maxunicode + 1)
        letter = np.fromiter((chr(c).isalpha() for c in points), bool, len(points))
        begins = np.array([a for a, _ in SCRIPTS])
        numbers = np.array([SCRIPT_NAMES.index(n) for _, n in SCRIPTS], np.uint8)
        _tables.append((letter, numbers[np.searchsorted(begins, np.arange(len(points)), "right") - 1]))
    return _tables[0]


def script_of(char: str) -> str:
    return SCRIPTS[bisect_right([a for a, _ in SCRIPTS], ord(char)) - 1][1]


def letters_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigram bucket of each letter, first letter of each word, its code point) in lower case."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    inside = letter_tables()[0][points]
    at = np.flatnonzero(inside)
    if not len(at):
        return at, at, points[:0]
    padded = np.zeros(len(points) + 2, np.uint32)
    padded[1:-1] = np.where(inside, points, 0)
    a, b, c = padded[at], padded[at + 1], padded[at + 2]
    bucket = (a * np.uint32(2654435761) ^ b * np.uint32(2246822519) ^ c * np.uint32(3266489917)) * np.uint32(668265263) >> np.uint32(16)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1] + 1]))
    return bucket & np.uint32(BUCKETS - 1), first, b[first]


class Model:
    """Log scores of trigram buckets per language, and which languages each script has."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        smooth = counts + 0.5
        logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)).T
        self.logs = np.ascontiguousarray((logs - logs.mean(axis=1, keepdims=True)).astype(np.float32))
        share = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        self.allowed = (share >= 0.01).T  # script x language
        self.usual = int(np.argmax(counts.sum(axis=1)))

    def words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(score of each word per language, its letters; 0 letters if no language has its script)."""
        scores, letters = [], []
        for i in range(0, len(text), PIECE):
            bucket, first, points = letters_of(text[i : i + PIECE])
            if len(first):
                own = np.add.reduceat(self.logs[bucket], first, axis=0)
                n = np.diff(np.append(first, len(bucket)))
                ok = self.allowed[letter_tables()[1][points]]
                any_ = ok.any(axis=1)
                own += np.where(ok, np.float32(0), np.float32(UNKNOWN))
                own[~any_] = 0
                scores.append(own)
                letters.append(np.where(any_, n, 0))
        if not scores:
            return np.zeros((0, len(self.langs)), np.float32), np.zeros(0, np.int64)
        return np.concatenate(scores), np.concatenate(letters)


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """The best language of each word; words bounds[i]..bounds[i+1] are one text. All texts advance together."""
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    starts, n = bounds[:-1][order], n[order]
    langs = scores.shape[1]
    came = np.zeros(scores.shape, np.int8 if langs < 128 else np.int16)
    path = np.zeros(len(scores), np.int64)
    steps = int(n[0]) if len(n) else 0
    live = np.searchsorted(-n, -np.arange(steps), "left")  # texts longer than t words
    own = np.arange(langs)
    value = np.zeros((len(n), langs), np.float32)
    ended = np.zeros(len(n), np.int64)
    for t in range(steps):
        k = live[t]
        at = starts[:k] + t
        v = value[:k]
        if t:
            best = v.argmax(axis=1)
            floor = v[np.arange(k), best][:, None] - np.float32(penalty)
            came[at] = np.where(v >= floor, own, best[:, None])
            v = np.maximum(v, floor)
        v = v + scores[at]
        value[:k] = v - v.max(axis=1, keepdims=True)
        end = live[t + 1] if t + 1 < steps else 0
        if end < k:
            ended[end:k] = value[end:k].argmax(axis=1)
    state = ended.copy()
    for t in range(steps - 1, -1, -1):
        k = live[t]
        at = starts[:k] + t
        path[at] = state[:k]
        state[:k] = came[at, state[:k]]
    return path


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on rows of ``docs`` with a language, at most about ``FIT_ROWS`` of them, chosen by a hash of id and text.

    Null texts and null languages are left out; empty texts, repeated rows and null ids do no harm. Without a
    labelled row the model knows no language, and every text is ``und``. An empty sample of labelled rows,
    or more than ``MOST_LANGS`` languages, is an error.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()}
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    langs, total = sorted(sizes), sum(sizes.values())
    if not langs:
        return Model(["und"], np.zeros((1, BUCKETS)), np.zeros((1, len(SCRIPT_NAMES))))
    share = min(1.0, FIT_ROWS / total)
    number = {x: i for i, x in enumerate(langs)}

    def count(batches):
        counts = np.zeros((len(langs), BUCKETS), np.int64)
        scripts = np.zeros((len(langs), len(SCRIPT_NAMES)), np.int64)
        n = 0
        for batch in batches:
            n += batch.num_rows
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i in range(0, len(text), PIECE):
                    bucket, _, points = letters_of(text[i : i + PIECE])
                    counts[number[lang]] += np.bincount(bucket, minlength=BUCKETS)
                    scripts[number[lang]] += np.bincount(letter_tables()[1][points], minlength=len(SCRIPT_NAMES))
        yield pa.RecordBatch.from_arrays([pa.array([counts.astype("<i4").tobytes()]), pa.array([scripts.astype("<i4").tobytes()]), pa.array([n])], ["counts", "scripts", "n"])

    sample = rows.where(sampled(share, "id", "text")).select("text", "lang")
    parts = sample.repartition(FIT_PARTS).mapInArrow(count, schema_of("counts binary, scripts binary, n bigint")).collect()
    if not sum(p.n for p in parts):
        raise ValueError("the sample of labelled rows is empty")
    counts = sum((np.frombuffer(p.counts, "<i4").reshape(len(langs), -1).astype(np.int64) for p in parts), np.zeros((len(langs), BUCKETS), np.int64))
    scripts = sum((np.frombuffer(p.scripts, "<i4").reshape(len(langs), -1).astype(np.int64) for p in parts), np.zeros((len(langs), len(SCRIPT_NAMES)), np.int64))
    return Model(langs, counts, scripts)


def label(model: Model, texts: list[str | None]) -> tuple[list[str], list[float], list[list[tuple[int, int, str]]]]:
    """(language, share of letters in its spans, spans of words) of each text."""
    scores, letters = zip(*(model.words(t or "") for t in texts), strict=True)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in letters])])
    path, letters = viterbi(np.concatenate(scores), bounds), np.concatenate(letters)
    langs, sure, spans, alpha = [], [], [], letter_tables()[0]
    for i, text in enumerate(texts):
        a, b = bounds[i], bounds[i + 1]
        by = np.bincount(path[a:b], weights=letters[a:b], minlength=len(model.langs))
        total = by.sum()
        if total:
            best = int(np.argmax(by))
            langs.append(model.langs[best])
            sure.append(float(by[best] / total))
        elif text and alpha[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)].any():
            langs.append(model.langs[model.usual])
            sure.append(0.0)
        else:
            langs.append("und")
            sure.append(0.0)
        cuts = [0, *(np.flatnonzero(np.diff(path[a:b])) + 1).tolist(), int(b - a)]
        spans.append([(x, y, model.langs[path[a + x]]) for x, y in zip(cuts, cuts[1:], strict=False) if y > x])
    return langs, sure, spans


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: tuple[str, str, str] = ("lang_pred", "score", "lang_spans"), spans: bool = True) -> DataFrame:
    """``docs`` with the language, the share of letters in its spans, and the spans (first word, end, language).

    A null text or one without letters is ``und`` with score 0; letters of scripts that no learned language
    has give the most frequent language with score 0. Rows keep all their columns; one that has
    the name of an output is replaced. Ties go to the language first in order. Words are runs of letters.
    """
    rest = [c for c in docs.columns if c not in out]
    at = rest.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, sure, found = [], [], []
        _, offsets = flat_bytes(batch.column(at).fill_null("").cast(pa.binary()))
        for a, b in row_blocks(offsets, BATCH_BYTES):
            for out_, more in zip((langs, sure, found), label(model, batch.column(at)[a:b].to_pylist()), strict=True):
                out_ += more
        arrays = [*batch.columns, pa.array(langs), pa.array(sure, pa.float64())]
        if spans:
            kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            arrays.append(pa.array([[{"first": a, "end": b, "lang": c} for a, b, c in s] for s in found], kind))
        return pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, *out[: 2 + spans]])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(rest).schema)
    return arrow_map(docs.select(rest), run, f"{ddl}, `{out[0]}` string, `{out[1]}` double" + f", `{out[2]}` array<struct<first:bigint,end:bigint,lang:string>>" * spans)
