"""Each corpus operator against a plain version, on small and awkward tables."""

import hashlib
import random

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from stationlab.llm import chat, components, decontaminate, html_text, language, mixing, quality, recompression, run_index, simhash, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, doc string, spans int, whole string, item string"


def frame(spark, rows, schema=SCHEMA):
    """(id, text) rows with languages, sources and columns of clashing names."""
    full = [(i, t, ["en", "de", None][k % 3], [None, "b", "a", "b"][k % 4], None if t is None else len(t), "x", "y", 1, "z", "w") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3)


def awkward(seed=1, n=60):
    """Few words and many repeats: runs, periods, copies, shared passages; nulls, blanks, repeated rows and ids."""
    r = random.Random(seed)
    vocabulary = ["a", "b", "c", "Dé", "e,", "ß"] + [f"w{i}" for i in range(200)]
    passages = [[r.choice(vocabulary) for _ in range(r.randint(40, 130))] for _ in range(5)]
    texts = []
    for k in range(n):
        w = []
        for _ in range(r.randint(1, 5)):
            kind = r.random()
            if kind < 0.3:
                p = r.choice(passages)
                a = r.randint(0, 20)
                w += p[a : len(p) - r.randint(0, 20)]
            elif kind < 0.45:
                w += [r.choice("ab")] * r.randint(1, 120)
            elif kind < 0.6:
                w += [r.choice(vocabulary) for _ in range(r.randint(2, 5))] * r.randint(1, 40)
            else:
                w += [r.choice(vocabulary) for _ in range(r.randint(1, 120))]
        texts.append(r.choice([" ", "\n", " \t"]).join(w))
    rows = list(enumerate(texts)) + [(100 + k, texts[k]) for k in range(8)]
    rows += [(200, None), (201, ""), (202, " \n"), (203, "x"), (5, texts[5]), (5, texts[6]), (None, texts[7]), (None, texts[9] + " tail"), (204, "!!! ***")]
    return rows


def by_row(rows):
    return sorted(map(repr, rows))


def test_mixing(spark):
    rows = awkward()
    docs = frame(spark, rows)
    got = mixing.mix_report(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in got) == sorted((i is None, i or 0, len(plain.words(t))) for i, t in rows)
    total = sum(r["size"] for r in got)
    targets = {r.source: (r.source_size, r.target) for r in got}
    assert abs(sum(t for _, t in targets.values()) - 1.5 * total) < 1e-6 * total or all(t >= 2 * s for s, t in targets.values())
    for source, (size, target) in targets.items():
        taken = [r for r in got if r.source == source]
        assert target <= 2 * size + 1e-9
        assert abs(sum(r.taken for r in taken) - target) <= max(r["size"] for r in taken)
        assert all(r.taken <= 2 * r["size"] for r in taken)
    again = mixing.mix_report(docs.repartition(5)).collect()
    assert by_row(again) == by_row(got)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "repetition"]
    assert sum(len(plain.words(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix_report(docs.limit(0)).count() == 0


def test_chat_round_trip(spark):
    r = random.Random(3)
    marks = ["<s>", "</s>", "[INST]", "[/INST]", "[JOIN]", "<\\s>", "\\", "<", "[", "</s", "$1", "text ", "\n", "é", ""]
    rows = []
    for c in [1, 2, 3, None]:
        for t in range(12):
            rows.append((c, r.choice([t, t // 2, None]), r.choice(["user", "assistant", "sys</s>tem", None]), r.choice([None, "".join(r.choice(marks) for _ in range(6))]), 9))
    rows += [rows[0], rows[0]]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    out = chat.format_conversations(turns)
    back = out.select("conv_id", "formatted", "segments", chat.parse_formatted(F.col("formatted")).alias("back"), chat.masked_text(F.col("segments")).alias("loss")).collect()
    assert len(back) == 4
    for b in back:
        own = sorted((x for x in rows if x[0] == b.conv_id), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(t.role, t.text) for t in b.back] == [(x[2] or "", x[3] or "") for x in own]
        assert b.loss == "".join(x[3] or "" for x in own if x[2] == "assistant")
        n_runs = sum(k == 0 or own[k][2] != own[k - 1][2] for k in range(len(own)))
        assert b.formatted.count("</s>") == b.formatted.count("<s>[INST]") == n_runs
        assert "".join(s.text for s in b.segments) == b.formatted
    assert chat.format_digest(chat.format_conversations(turns.limit(0))).count() == 0


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    net = language.fit_language(docs.filter(~held))
    told = docs.filter(held).select("lang", language.language_of(net, F.col("text")).alias("r")).collect()
    assert sum(r.lang == r.r.lang_pred for r in told) >= 0.95 * len(told)
    rows = [(1, None), (2, ""), (3, "12 34 !"), (4, "the and of that with " * 4000), (5, "the and of that with"), (6, "the and of that with")]
    odd = {r.doc_id: r.r for r in frame(spark, rows).select("doc_id", language.language_of(net, F.col("text")).alias("r")).collect()}
    assert all(tuple(odd[i]) == ("und", 0.0) for i in (1, 2, 3))
    assert odd[4].lang_pred == "en" and odd[5] == odd[6] and 0 < odd[5].score <= 1
    none = language.fit_language(docs.limit(0))
    assert docs.limit(3).select(language.language_of(none, F.col("text")).alias("r")).filter("r.lang_pred = 'und'").count() == 3


def test_decontamination(spark):
    rows = awkward(4)
    items = [(1, " ".join(plain.words(rows[0][1])[3:40])), (2, rows[1][1]), (3, "W3 w4"), (4, None), (5, "..."), (6, "x"), (None, "a " * 30), (1, rows[2][1]), (7, "nowhere at all"), (2, rows[1][1])]
    bench = spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, key string")
    want = plain.contamination(rows, items)
    for block in (200_000, 7):
        got = decontaminate.contamination(frame(spark, rows), bench, block_terms=block).drop("items").collect()
        assert by_row(map(tuple, got)) == by_row(want)
    kept = decontaminate.drop_contaminated(frame(spark, rows), bench)
    assert len(kept.columns) == 10
    assert by_row((r.doc_id, r.text) for r in kept.collect()) == by_row((i, t) for (i, t), w in zip(rows, want, strict=True) if not w[5])
    assert {r.n_hit for r in decontaminate.contamination(frame(spark, rows), bench.limit(0)).collect()} == {0}
    assert decontaminate.contamination(frame(spark, rows).limit(0), bench).count() == 0
    near = decontaminate.proximity_matches(frame(spark, rows), bench).select("key").distinct().count()
    assert near >= decontaminate.exact_matches(frame(spark, rows), bench).select("key").distinct().count() > 0


def test_quality(spark):
    rows = awkward(5) + [(300, "Good plain words of a text, as they stand in many others. " * 3), (301, "### $$$ %%% &&& " * 60)]
    got = quality.judge_quality(frame(spark, rows)).collect()
    want = [(i, *plain.quality_base(t)) for i, t in rows]
    assert by_row((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == by_row(want)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and (r.class_distance or 0) <= 0.2 and (r.word_distance or 0) <= 0.5)
    assert quality.judge_quality(frame(spark, rows).limit(0)).count() == 0
    assert quality.js_distance(np.array([1.0, 0]), np.array([0, 1.0])) == 1.0 and quality.js_distance(np.array([1.0, 3]), np.array([2.0, 6])) == 0.0


def test_simhash(spark):
    rows = awkward(6)
    got = {}
    for r in simhash.simhash_report(frame(spark, rows)).collect():
        got.setdefault((r.doc_id, r.fingerprint), set()).add(r.component_id)
    order = sorted(rows, key=lambda x: (x[0] is None, x[0] or 0))
    fps = [plain.fingerprint(t) for _, t in order]
    roots = plain.groups(fps)
    for (i, _), f, g in zip(order, fps, roots, strict=True):
        assert got[i, f"{f:016x}"] == {order[g][0]}
    kept = simhash.drop_near_duplicates(frame(spark, rows)).collect()
    group = dict(zip(fps, roots, strict=True))
    assert sorted(group[plain.fingerprint(r.text)] for r in kept) == sorted(set(roots))
    assert all(r.doc_id == order[group[plain.fingerprint(r.text)]][0] for r in kept)
    assert simhash.simhash_report(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("cell", [4, 128])
def test_simhash_links_in_dense_cells(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)
    r = random.Random(cell)
    fps = {0}
    for centre in (r.getrandbits(64), 2**64 - 1, 0):
        x = centre
        for _ in range(60):
            fps.add(centre ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
            x ^= (1 << r.randrange(64)) ^ (1 << r.randrange(64))  # a chain
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long").repartition(3)
    roots = {r.node: r.root for r in components.connected_components(simhash.fingerprint_links(df)).collect()}
    want = plain.groups(fps)
    pairs = {}
    for f, g in zip(fps, want, strict=True):
        s = f - 2**64 if f >= 2**63 else f
        pairs.setdefault(g, set()).add(roots.get(s, s))
    assert all(len(v) == 1 for v in pairs.values()) and len({next(iter(v)) for v in pairs.values()}) == len(pairs)


def test_toxicity(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit_toxicity(docs.filter(~held), labels.filter(~held))
    got = docs.filter(held).join(labels, "doc_id").select("toxic", toxicity.toxicity_of(model, F.col("text")).alias("s")).collect()
    yes, no = [r.s for r in got if r.toxic == 1], [r.s for r in got if r.toxic == 0]
    no_ = np.array(no)
    auc = np.mean([(a > no_).mean() + 0.5 * (a == no_).mean() for a in yes])
    assert auc >= 0.95 and all(0 <= r.s <= 1 for r in got)
    odd = frame(spark, [(1, None), (2, ""), (3, "idiot " * 50_000)]).select("doc_id", toxicity.toxicity_of(model, F.col("text")).alias("s")).collect()
    assert len(odd) == 3 and all(0 <= r.s <= 1 for r in odd)
    assert 0 <= toxicity.fit_toxicity(docs, labels.limit(0)).score(b"x") <= 1


def test_run_index_structures():
    r = np.random.default_rng(1)
    for k in range(30):
        s = r.integers(1, 3 if k % 2 else 30, int(r.integers(1, 200)))
        s = np.concatenate([s, s[: len(s) // 2], s]) if k % 3 == 0 else s
        t = s.tolist()
        assert run_index.suffix_array(s).tolist() == sorted(range(len(t)), key=lambda i: t[i:])

        def common(a, b, t=t):
            m = 0
            while max(a, b) + m < len(t) and t[a + m] == t[b + m]:
                m += 1
            return m

        want = [max((common(i, j) for j in range(len(t)) if j != i), default=0) for i in range(len(t))]
        index = run_index.RunIndex(s)
        assert index.matching_statistics().tolist() == want and index.lengths.sum() == len(t)


@pytest.mark.parametrize("large", [4_000_000, 1500])
def test_run_index(spark, large):
    rows = awkward(7, 40) + [(400, "z" * 900), (401, "q" + "z" * 300), (402, "ab" * 400)]
    report = run_index.repeated_bytes(frame(spark, rows), batch_bytes=3000, large=large)
    lost = {bytes(r.key): r for r in report.collect()}
    got = []
    for i, t in rows:
        raw = (t or "").encode()
        r = lost.get(hashlib.md5(raw).digest())
        runs, kept = run_index.kept_bytes(raw, r and r.spans, bool(r and r.whole), 200)
        got.append((i, len(raw), len(raw) - len(kept), runs, plain.sha(kept)))
    assert by_row(got) == by_row(plain.byte_repeats(rows))
    if large > 2000:
        assert by_row(map(tuple, run_index.dedup_report(frame(spark, rows)).collect())) == by_row(got)
        assert run_index.dedup_report(frame(spark, rows).limit(0)).count() == 0


def test_html_text():
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>'
        "<main><h1>Head &amp; line</h1><p>First  para\n with <b>bold<p>second &lt;b&gt;<br>line</p><ul><li>one<li>two</ul>"
        '<aside>more</aside><form>mail <input></form></main><section id="comments"><p>nice comment of some length, longer than all else here</p></section>'
        '<div class="ad">buy</div><script>var t="</p>";</script><footer>&copy; me</footer></body></html>'
    )
    assert html_text.extract(page) == "Head & line\n\nFirst para with bold\n\nsecond <b> line\n\none\n\ntwo"
    plain_page = '<body><div id="menu"><a>a</a><a>b</a></div><div><h2>Title of it</h2><p>Some long text, and more of it.</p><p>And again some text here.</p></div></body>'
    assert html_text.extract(plain_page) == "Title of it\n\nSome long text, and more of it.\n\nAnd again some text here."
    assert [html_text.extract(x) for x in (None, "", "  ", "<p>", "<", "just text", "<!-- x", "<p title='a>b'>t")] == ["", "", "", "", "<", "just text", "", "t"]
    assert html_text.extract("<p>" * 3000 + "deep" + "<div>" * 3000) == "deep"


def test_html_column(spark):
    pages = frame(spark, [(1, None), (2, "<p>x</p>"), (2, "<p>x</p>"), (3, "<p>" + "long text " * 50_000)])
    got = pages.select("doc_id", html_text.main_text(F.col("text")).alias("t")).collect()
    assert sorted(len(r.t) for r in got) == [0, 1, 1, 499_999]


@pytest.mark.parametrize("seed", [8, 9])
def test_recompression(spark, seed):
    rows = awkward(seed)
    got = recompression.dedup_report(frame(spark, rows)).collect()
    want = [(i, n, n - len(k), plain.sha(" ".join(k).encode())) for i, n, k in plain.word_repeats(rows)]
    assert by_row(map(tuple, got)) == by_row(want)
    if seed == 8:
        left = recompression.drop_repeats(frame(spark, rows)).collect()
        expect = [(i, t if len(k) == n else " ".join(k)) for (i, t), (_, n, k) in zip(rows, plain.word_repeats(rows), strict=True) if k or not n]
        assert by_row((r.doc_id, r.text) for r in left) == by_row(expect)
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in left)
        assert recompression.dedup_report(frame(spark, rows).limit(0)).count() == 0


def test_recompression_in_slices(spark, monkeypatch):
    monkeypatch.setattr(recompression, "SLICE", 120)
    rows = awkward(10, 25)
    got = recompression.dedup_report(frame(spark, rows)).collect()
    assert by_row(map(tuple, got)) == by_row((i, n, n - len(k), plain.sha(" ".join(k).encode())) for i, n, k in plain.word_repeats(rows))


def test_mix_replaces_a_column_of_its_name(spark, tmp_path):
    docs = spark.createDataFrame([(i, "a b c", "s", 9, 9) for i in range(20)], "doc_id long, text string, source string, Repetition int, _size int")
    mixing.mix(docs).write.parquet(str(tmp_path / "mix"))
    out = spark.read.parquet(str(tmp_path / "mix"))
    assert out.columns == ["doc_id", "text", "source", "_size", "repetition"]
    assert out.count() == 30 and out.agg(F.max("repetition")).first()[0] == 2


def test_toxic_words_are_not_capped():
    """Each positive text has words of its own among 3,000 that mark toxic ones."""
    words = [f"bad{i}" for i in range(3000)]
    positive = [" ".join(sorted(words[(7 * i + k) % 3000] for k in range(60))).encode() for i in range(1500)]
    unlabelled = [" ".join(sorted(f"plain{(i + k) % 50}" for k in range(10))).encode() for i in range(1500)]
    model = toxicity.train(positive, unlabelled, 0.2)
    assert len(model.words) == 3000
    assert all(model.score(w.encode()) > model.score(b"plain1") for w in words)


def test_toxicity_of_empty_and_odd_tables(spark):
    docs, labels = frame(spark, []), spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(docs, labels)
    assert docs.select(toxicity.toxicity_of(model, F.col("text")).alias("s")).collect() == []
    rows = [(i, f"awful nasty{i % 3} words" if i % 2 else f"calm plain{i % 3} words") for i in range(60)]
    odd = frame(spark, rows).withColumn("toxic", F.lit(1)).withColumn("w", F.lit("x")).withColumn("_y", F.lit(0))
    labels = spark.createDataFrame([(i, v) for i in range(60) for v in (0, i % 2)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit_toxicity(odd, labels)
    assert model.score(b"awful nasty1 words") > 0.5 > model.score(b"calm plain1 words")
