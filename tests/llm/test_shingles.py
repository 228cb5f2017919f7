"""The pipeline's near-dedup against brute force over sets of five-word shingles."""

import random

import corpus_pipeline
from pagemill.llm import shingles


def edited(words, n, r):
    out = list(words)
    for at in r.sample(range(len(out)), n):
        out[at] = f"edit{r.randrange(10**9)}"
    return out


def sets_of(texts):
    found = []
    for t in texts:
        w = (t or "").lower().split()
        found.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return found


def first_of_groups(texts):
    """The least position of each group of texts linked at 0.8 or more."""
    sets, root = sets_of(texts), list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            either = len(sets[a]) + len(sets[b]) - both
            if sets[a] == sets[b] or both * 10 >= either * 8:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {i for i in range(len(texts)) if top(i) == i}


def test_pipeline_keeps_one_of_each_group(spark):
    """Edits that leave similarities from 0.6 to 1, a crowded group, a chain, short texts, blanks and nulls."""
    r, texts = random.Random(1), []
    for k in range(60):
        base = [f"w{k}x{r.randrange(400)}" for _ in range(r.choice([40, 120, 300, 3000]))]
        texts += [" ".join(base), " ".join(edited(base, max(1, len(base) * (k % 8) // 160), r))]
    crowd = [f"c{r.randrange(500)}" for _ in range(200)]
    texts += [" ".join(edited(crowd, r.randrange(1, 6), r)) for _ in range(80)]
    chain = [f"d{r.randrange(500)}" for _ in range(200)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = edited(chain, 3, r)
    texts += ["one", "One ", "one two", "a b c d e f", "", None, " \n ", texts[0].upper()]
    order = list(range(len(texts)))
    r.shuffle(order)
    docs = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string").repartition(3)
    assert {x.doc_id for x in corpus_pipeline.near_dedup(spark, docs, "").collect()} == first_of_groups(texts)


def test_no_rows(spark):
    assert not shingles.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect()
