"""Near duplicates by shingles against all pairs, and the recall of the pipeline's stage."""

import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationlab.llm import common, shingle_join, simhash


def sets(t, size=5):
    w = plain.words(plain.lower(t))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)}


def similar(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def groups(texts):
    """Root of each position over all pairs."""
    s = [sets(t) for t in texts]
    root = list(range(len(s)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(s):
        for j in range(i):
            if min(len(x), len(s[j])) >= 0.8 * max(len(x), len(s[j])) and similar(x, s[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(s))]


def changed(words, edits, r):
    w = list(words)
    for k in r.sample(range(len(w)), edits):
        w[k] = f"n{r.random()}"
    return w


def planted(seed=4):
    """Near copies on both sides of the threshold, chains of them, a large group, one line in very many texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(r.choice(vocabulary) for _ in range(12))
    texts = []
    for _ in range(25):
        w = [r.choice(vocabulary) for _ in range(r.randint(1, 300))]
        texts.append(" ".join(w))
        for _ in range(3):
            w = changed(w, min(len(w), round(len(w) * r.choice([0.005, 0.01, 0.02, 0.025]))), r)
            texts.append(" ".join(w))
    big = [r.choice(vocabulary) for _ in range(150)]
    texts += [" ".join(changed(big, r.randint(0, 4), r)) for _ in range(60)]
    texts += [f"{line} {' '.join(r.choice(vocabulary) for _ in range(r.randint(0, 30)))}" for _ in range(60)]
    return texts + [None, "", " \n", "x", "X", "a b c", "a b c d e", "a b c d e f"] + texts[:5]


@pytest.mark.parametrize("sample", [1, 16])
def test_components_are_those_of_all_pairs(spark, monkeypatch, sample):
    monkeypatch.setattr(shingle_join, "SAMPLE", sample)
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, 5, min_similarity=0.8).collect()}
    assert [got[k] for k in range(len(texts))] == groups(texts)
    assert simhash.near_duplicates(docs.limit(0), 5, min_similarity=0.8).count() == 0


def test_stage_finds_the_near_copies_of_the_documents(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    roots = groups([t for _, t in rows])
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, docs, d)
    assert sorted(r.doc_id for r in kept.collect()) == [rows[k][0] for k in sorted(set(roots))]


def test_a_group_of_near_copies_is_not_compared_pair_by_pair(spark, monkeypatch):
    r = random.Random(9)
    base = [f"w{r.randint(0, 400)}" for _ in range(170)]
    texts = [" ".join(changed(base, r.randint(3, 5), r)) for _ in range(160)]
    compared, plain_verified = [], shingle_join._verified

    def noted(all_texts, pairs, *more):
        compared.append(pairs.count())
        return plain_verified(all_texts, pairs, *more)

    monkeypatch.setattr(shingle_join, "_verified", noted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {row.doc_id: row.component_id for row in simhash.near_duplicates(docs, 5, min_similarity=0.8).collect()}
    assert [got[k] for k in range(len(texts))] == groups(texts)
    assert sum(compared) < 10 * len(texts)


def test_components_are_sought_twice_before_the_last_links(spark, monkeypatch):
    """Each search takes some ten shuffles a round, whatever the size; six of them filled the disk with files and events."""
    sought, plain_components = [], shingle_join.connected_components

    def noted(edges):
        sought.append(1)
        return plain_components(edges)

    monkeypatch.setattr(shingle_join, "connected_components", noted)
    docs = spark.createDataFrame(list(enumerate(planted()[:60])), "doc_id long, text string")
    shingle_join.similar_links(docs, 5, 0.8, proposed=simhash.proposed_pairs(docs, 5)).count()
    assert len(sought) <= 2


def cut(rows, names, r):
    """Columns of sorted rows in batches of any length."""
    at = sorted({0, len(rows), *(r.randrange(len(rows)) for _ in range(8))})
    types = {"n": pa.int32(), "at": pa.int32()}
    for i, j in zip(at, at[1:], strict=False):
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows[i:j]], types.get(c, pa.int64())) for k, c in enumerate(names)], names)


def fits(x, y, t=0.8):
    needed = np.ceil(t / (1 + t) * (x[2] + y[2]) - 1e-6)
    return x[0] == y[0] and x[4] != y[4] and min(x[2], y[2]) >= t * max(x[2], y[2]) - 1e-6 and min(x[2] - x[3], y[2] - y[3]) >= needed


@pytest.mark.parametrize("seed", range(6))
def test_open_rows_and_forest_against_all_pairs(monkeypatch, seed):
    r = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(shingle_join, "HELD", 9)
    names = ["token", "key", "n", "at", "root", *(f"s{i}" for i in range(shingle_join.SKETCH))]
    rows = set()
    for token in range(40):
        for key in r.sample(range(30), r.choice([2, 3, 5, 20])):
            rows.add((token, key, 100 + 7 * (key % 9), r.randrange(25), key % 11, *(key & 7,) * shingle_join.SKETCH))
    rows = sorted({(x[0], x[1]): x for x in rows}.values(), key=lambda x: (x[0], x[2], x[1]))
    pairs = [(x, y) for k, x in enumerate(rows) for y in rows[:k] if fits(x, y)]
    kept = {x[:2] for b in shingle_join._open(0.8)(cut(rows, names[:5], r)) for x in zip(*(c.to_pylist() for c in b.columns), strict=True)}
    assert kept >= {z[:2] for p in pairs for z in p}
    if not seed % 2:
        assert kept == {z[:2] for p in pairs for z in p}
    # what the forest joins inside each cell is what all allowed pairs join
    found = {(a, b) for x in shingle_join._forest(0.8)(cut(rows, names, r)) for a, b in zip(*(c.to_pylist() for c in x.columns), strict=True)}
    allowed = [(x, y) for x, y in pairs if sum(int(a ^ b).bit_count() for a, b in zip(x[5:], y[5:], strict=True)) <= (x[2] + y[2]) / 9 + 1e-6]
    assert found and found <= {(min(x[1], y[1]), max(x[1], y[1])) for x, y in allowed}

    def groups_of(links):
        root = {}

        def find(i):
            while root.setdefault(i, i) != i:
                i = root[i]
            return i

        for a, b in links:
            root[find(a)] = find(b)
        return {i: min(j for j in root if find(j) == find(i)) for i in list(root)}

    own = [(x[1], -1 - x[4]) for x in rows]
    assert groups_of(own + list(found)) == groups_of(own + [(x[1], y[1]) for x, y in allowed])


@pytest.mark.parametrize("words", [1, 1 << 19])
def test_no_table_of_texts_passes_the_driver(spark, monkeypatch, words):
    """Copies of tables that grow with the documents, up to 500,000 rows of each, filled the driver's memory."""
    sent, plain_broadcast = [], F.broadcast

    def noted(df):
        sent.append(df.count())
        return plain_broadcast(df)

    monkeypatch.setattr(F, "broadcast", noted)
    monkeypatch.setattr(common, "FILTER_WORDS", words)  # one word is full, and the joins settle all rows
    texts = planted()
    rows = list(enumerate(texts)) + list(enumerate(texts[:9]))
    kept = corpus_pipeline.keep_one_of_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups(texts)))
    assert sum(sent) == 0


def test_filter_passes_its_keys_and_few_others(spark):
    keys = spark.range(0, 40000, 2).select(F.xxhash64("id").alias("key"))
    told = spark.range(40000).withColumn("told", common.may_be_among(keys, "key")(F.xxhash64("id")))
    found = {r.even: (r.n, r.told) for r in told.groupBy((F.col("id") % 2 == 0).alias("even")).agg(F.count("*").alias("n"), F.sum(F.col("told").cast("int")).alias("told")).collect()}
    assert found[True] == (20000, 20000) and found[False][1] < 1200
    assert not told.limit(9).withColumn("told", common.may_be_among(keys.limit(0), "key")(F.xxhash64("id"))).filter("told").count()


def test_common_shingles_are_the_most_frequent(spark, monkeypatch):
    r = random.Random(3)
    lines = [" ".join(f"l{k}x{i}" for i in range(5)) for k in range(300)]
    texts = [" ".join([f"t{n}", *r.sample(lines, 30), *([lines[0]] if n % 2 else [])]) for n in range(60)]
    count = {}
    for t in texts:
        for s in shingle_join.shingles(t).tolist():
            count[s] = count.get(s, 0) + 1
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    monkeypatch.setattr(shingle_join, "SAMPLE", 1)
    token, rank = shingle_join._common(docs, 5)
    assert set(token.tolist()) == {s for s, n in count.items() if n > 2}
    assert sorted(token[np.argsort(rank)].tolist(), key=count.get) == token[np.argsort(rank)].tolist() and sorted(rank.tolist()) == list(range(1, len(token) + 1))
    monkeypatch.setattr(shingle_join, "COMMON", 100)
    some = set(shingle_join._common(docs, 5)[0].tolist())
    least = min(count[s] for s in some)
    assert 60 < len(some) < 140 and {s for s, n in count.items() if n > least} <= some
