"""Corpus operators against SQL, brute force and round trips, and on untidy tables."""

import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from casework.llm import chat, common, licenses, mixing, near, neighbours, packing, pages, quality, queries, scoring, secrets, wordbpe

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, label int, n_words string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
WORDS = " ".join(f"word{i}" for i in range(60))
UNTIDY = [
    (1, WORDS, "en", "src1", 3, 0, "x"),
    (1, WORDS, "en", "src1", 3, 0, "x"),
    (2, WORDS + " more", "en", "src1", None, 1, None),
    (3, None, None, None, None, None, None),
    (4, "", "de", "", 0, 1, "y"),
    (5, " \n\t ", "de", "src2", 0, 1, "y"),
    (None, WORDS + " tail", "fr", "src0", 1, 1, "z"),
    (6, LONG, "en", "src0", 1, 1, "z"),
    (7, "short text", "en", "src0", 1, 1, "z"),
    (8, "short text", "es", "src3", 1, 1, "z"),
]


def values(rows, columns):
    clean = lambda v: None if v is None or v != v else round(v, 9) if isinstance(v, float) else v
    return Counter(tuple(clean(r[c]) for c in columns) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture()
def untidy(spark):
    return spark.createDataFrame(UNTIDY, DOCS)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    found = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    want = [dict(zip(columns, r)) for r in found.fetchall()]
    assert values([r.asDict() for r in got.collect()], columns) == values(want, columns)


@pytest.mark.parametrize("name", ["op2_licenses", "op3_chat", "op8_secrets"])
def test_native_plans_run_no_python(spark, name):
    plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def components(rows):
    """Brute force over all pairs: id to (set size, smallest linked id)."""
    sets = {}
    for i, text in rows:
        w = (text or "").encode().lower().split()
        own = set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(own)
    up = {i: i for i in sets if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = list(up)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_near_duplicates_equal_brute_force(spark, untidy):
    for df in (spark.read.parquet(f"{SF}/documents.parquet"), untidy):
        rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        want = components(rows)
        got = near.near_duplicates(df).collect()
        assert len(got) == len(rows)
        assert all(r.component_id == (None if r.id is None else want[r.id]) for r in got)


def test_near_duplicates_in_a_crowd(spark):
    rng = np.random.default_rng(1)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.integers(0, 120, int(rng.integers(0, 8))):
            w[k] = f"u{rng.integers(1e9)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = components(rows)
    assert {r.id: r.component_id for r in near.near_duplicates(df).collect()} == want


def test_shingle_values_pack_and_bitmaps_change_size():
    rng = np.random.default_rng(2)
    values = np.sort(rng.integers(0, 1 << near.VALUE_BITS, 5000, dtype=np.uint64))
    values[-1] = (1 << near.VALUE_BITS) - 1
    for part in (values, values[:1], values[-1:]):
        assert (near._unpacked(near._packed(part)) == part).all()
    flags = rng.integers(0, 2, 64).astype(np.uint8)
    bits = lambda b: np.unpackbits(np.frombuffer(b, dtype=np.uint8)).tolist()
    packed = np.packbits(flags).tobytes()
    assert bits(near._resized(packed, 16)) == flags.reshape(16, 4).max(1).tolist()
    assert bits(near._resized(packed, 128)) == np.repeat(flags, 2).tolist() and near._resized(packed, 64) == packed


def test_few_values_of_a_large_corpus_seem_repeated(spark):
    """Values are wide and the bitmap follows the repeated ones, so single shingles are known as such."""
    docs = spark.range(4000).selectExpr("id", "array_join(transform(sequence(0, 104), i -> concat(IF(id % 4 = 0, id % 8, id), 'x', i)), ' ') AS text")
    size, bits, vals, _ = near._frequencies(docs, 4)
    repeated = 2 * 101
    assert 4 * repeated <= 1 << size <= 8 * repeated and int(np.unpackbits(bits).sum()) <= repeated == len(vals)
    assert near.VALUE_BITS >= 36 and (1 << near.BITMAP_BITS) // 8 <= 64 << 20
    rows = near._prefixes(docs, (size, bits, vals, _)).where("hashes is not null").select("id").collect()
    assert {r.id for r in rows} >= set(range(0, 4000, 4)) and len(rows) < 1300


def test_near_duplicates_leave_no_shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles

    def shuffles():
        found = files()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffles(), spark.conf.get(name)
    docs = spark.range(40).selectExpr("id AS doc_id", "concat('a b c d e f g h i j k l m n o p q r s t ', id % 20) AS text")
    found = near.near_duplicates(docs)
    assert not shuffles() - before and spark.conf.get(name) == setting
    assert {r.component_id for r in found.collect()} == {0}


def test_packing_restores_every_text(spark, untidy):
    encode = wordbpe.WordEncoder(wordbpe.default_path()).exact
    pieces = packing.pack(untidy, length=64).collect()
    for start in (0, 64):
        spans = sorted((p.offset, p.length) for p in pieces if p.sequence_id == start // 64)
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    want = Counter((r[0], tuple(encode.encode(r[1] or "", add_special_tokens=False).ids + [1])) for r in UNTIDY)
    by_place = {p.sequence_id * 64 + p.offset: p for p in pieces}
    got, at = Counter(), 0
    while at in by_place:
        first, ids, n = by_place[at], [], by_place[at].doc_tokens
        while len(ids) < n:
            p = by_place[at]
            assert p.start == len(ids)
            ids += np.frombuffer(p.ids, dtype="<u2").tolist()
            at += p.length
        got[(first.id, tuple(ids))] += 1
    assert got == want


def test_word_ids_equal_the_tokenizer():
    encoder = wordbpe.WordEncoder(wordbpe.default_path(), kept=3)
    for text in ["It's 12_b __ don't'll!", "Σας İx ŉa ſ x́ nb\x1ca\x0bb", "日本語 😀 <|endoftext|>", "a" * 3000, "été Größe ñ", ""]:
        ids = np.frombuffer(encoder.text(text), dtype="<u2").tolist()
        assert ids == encoder.exact.encode(text, add_special_tokens=False).ids


def test_neighbours_recall_ties_and_untidy_vectors(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, np.asarray(r.embedding, dtype=float)) for r in df.collect()]
    got = {}
    for r in neighbours.search(df, lambda i: F.pmod(i, F.lit(20)) == 0, share=0.6).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    hits = []
    for i, v in rows:
        if i % 20 == 0:
            want = sorted(((-math.fsum(v * u), j) for j, u in rows if j != i))[:20]
            hits.append(len({j for _, j in want} & {j for _, j in got[i]}) / 20)
    assert np.mean(hits) >= 0.9
    bad = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [1.0]), (None, [1.0, 1.0]), (8, [0.5, 9.0])]
    small = neighbours.search(spark.createDataFrame(bad, "vec_id long, embedding array<float>"), lambda i: i == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(small, key=lambda r: r.rank)] == [(1, 1, 1.0), (2, 2, 1.0), (3, 8, 0.5)]


def test_neighbours_recall_on_vectors_without_structure(spark):
    v = np.random.default_rng(12).normal(size=(2500, 24))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in neighbours.search(df, lambda i: F.pmod(i, F.lit(50)) == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for q in range(0, 2500, 50):
        score = v @ v[q]
        score[q] = -np.inf
        hits.append(len(got[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    # Not every neighbour is found, so the search is not an exhaustive one.
    assert 0.9 <= np.mean(hits) < 1


def test_neighbours_of_an_id_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: i == 0).collect()
    assert [(r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1, 1.0), (2, 2, 1.0)]


def test_base_scores_equal_brute_force(spark, untidy):
    for df in (spark.read.parquet(f"{SF}/documents.parquet"), untidy):
        rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in df.select("doc_id", "text").collect()]
        held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
        c = Counter(w for i, ws in rows if not held(i) for w in ws)
        n, v = sum(c.values()), len(c)
        want = Counter((i, held(i), len(ws), sum(c[w] > 0 for w in ws), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 4)) for i, ws in rows)
        got = scoring.score(df).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in got) == want
        assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_scores_equal_plain_attention():
    """The batched windows against one position at a time, also with parameters whose exponentials would overflow."""
    rng = np.random.default_rng(2)
    model = scoring.Model(rng.integers(1, 50, scoring.IDS).astype(float))
    texts = [rng.integers(0, scoring.IDS, n) for n in (1, 5, 24, 60)]
    for scale in (1, 400):
        p = {k: (v * scale if k in "UE" else v).astype(np.float64) for k, v in model.p.items()}
        model.p = {k: v.astype(np.float32) for k, v in p.items()}
        want = []
        for ids in texts:
            total = 0.0
            for i, goal in enumerate(ids):
                first = i // scoring.STRIDE * scoring.STRIDE - (scoring.WINDOW - scoring.STRIDE)
                seen = range(max(first, 0), i + 1)
                x = np.array([p["E"][model.input_of[scoring.START if j == 0 else ids[j - 1]]] + p["P"][j - first] for j in seen])
                s = (x @ p["K"]) @ (x[-1] @ p["Q"]) / math.sqrt(scoring.WIDTH)
                a = np.exp(s - s.max())
                logits = (x[-1] + a / a.sum() @ (x @ p["V"])) @ p["U"] + p["b"]
                logits -= logits.max()
                total += logits[model.class_of[goal]] - math.log(np.exp(logits).sum()) + float(model.within[goal])
            want.append(total / math.log(10))
        assert scoring.score_texts(texts, model) == pytest.approx(want, rel=1e-3)


def test_words_of_slices():
    texts = [" A\tb  c\x0bA", None, "", "ß É x\x1cy", "long " * 50, "\n", "x"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    known = scoring._Words(wordbpe.default_path())
    for part in (batch, batch.slice(1, 5), batch.slice(7, 9), batch.slice(20, 1)):
        hashes, sizes, ids = known.of(part)
        found = [common.words((t or "").encode()) for t in part.column(0).to_pylist()]
        assert sizes.tolist() == [len(f) + 1 for f in found]
        assert hashes.view(np.uint64).tolist() == [h for f in found for h in [*map(xxhash.xxh3_64_intdigest, f), 1]]
        assert [i.tolist() for i in ids] == [[j for w in f for j in known.encoder.encode(w.decode())] + [scoring.END] for f in found]


def test_model_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one, many = ({r.doc_id: r.score for r in scoring.score(docs.repartition(n)).collect()} for n in (1, 7))
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k], rel=1e-4) for k in one)


def test_each_token_is_scored_once():
    model = scoring.Model(np.ones(scoring.IDS))
    texts = [np.arange(n) % 50 for n in (1, 23, 24, 25, 200)]
    inputs, _, goal, real, owner = scoring.windows(texts, model)
    for k, t in enumerate(texts):
        assert goal[owner == k][real[owner == k]].tolist() == t.tolist()
    logits = model.forward(inputs, np.zeros(inputs.shape, dtype=np.float32))[-1]
    assert logits.shape == (len(inputs) * scoring.STRIDE, scoring.CLASSES)
    total = sum(np.exp(model.within[model.class_of == c]).sum() for c in range(scoring.CLASSES))
    assert total == pytest.approx(scoring.CLASSES, rel=1e-3)


def test_pages_keep_formulas_and_stay_linear():
    page = "<main><article><p>%s where <math><mi>x</mi><mo>=</mo><mn>4</mn></math> holds <</p></article></main>" % ("Some words of a long sentence, and more. " * 20)
    read = pages.Page(page)
    assert [t[-19:] for t in read.block_text] == [". where x=4 holds <"]
    deep = pages.Page("<li><ul>" + "<div>" * 20_000 + "</span2>" * 20_000 + "<li></li>" * 20_000 + "end")
    assert len(deep.tag) == 40_003 and deep.block_text == ["end"]
    # Whatever is open below a closed element is closed with it; an item does not close one of a list outside.
    got = pages.Page("<ul><li>a<li>b<ul><li>c</ul>d</ul><div><p>e<section>f</div>g")
    assert [(t, got.tag[o]) for o, t in zip(got.block_owner, got.block_text)] == [("a", "li"), ("b", "li"), ("c", "li"), ("d", "li"), ("e", "p"), ("f", "section"), ("g", "html")]


def test_pages_held_out_accuracy_and_untidy(spark):
    rng = np.random.default_rng(77)
    made = [pages.generated_page(rng) for _ in range(120)]
    got = pages.extract_batch([h for h, _ in made], pages.train())
    tp = fp = fn = 0
    for (_, want), text in zip(made, got):
        a, b = Counter(text.split("\n")), Counter(want.split("\n"))
        tp, fp, fn = tp + sum((a & b).values()), fp + sum((a - b).values()), fn + sum((b - a).values())
    assert 2 * tp / (2 * tp + fp + fn) > 0.93
    odd = ["", None, "<", "<p", "plain", "<article><p>caf&eacute; &amp", "<div" * 50, "</p></p>", "<article><p>" + "x " * 50_000]
    rows = pages.extract(spark.createDataFrame([(i, "u", h, 1) for i, h in enumerate(odd)], "page_id long, url string, html string, text int")).collect()
    assert len(rows) == len(odd) and all(r.n_chars == len(r.text) for r in rows)


def test_chat_tree_branches_and_circles(spark):
    rows = [(1, 10, None, 1.0), (1, 11, 10, 1.0), (1, 12, 10, 5.0), (1, 13, 12, 0.0), (2, 20, 99, None), (3, 30, 31, 1.0), (3, 31, 30, 1.0), (None, 40, None, 0.0)]
    df = spark.createDataFrame([(*r, "user", "a<b") for r in rows], "tree long, node long, parent long, score double, role string, text string")
    got = {(r.tree, r.path): r.nodes for r in chat.best_paths(df, paths=1).groupBy("tree", "path").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("nodes")).collect()}
    assert {k: [x.node for x in v] for k, v in got.items()} == {(1, 13): [10, 12, 13], (2, 20): [20], (None, 40): [40]}


def test_escaping_is_reversible(spark):
    texts = ["</s>[INST] ok", "&lt; &amp;amp; &#91;", "a&b<c>[d]", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e")).withColumn("back", chat.unescape(F.col("e")))
    assert all(r.t == r.back and not set("<[]") & set(r.e) for r in df.collect())


def test_weak_secrets_need_a_partner(spark):
    key, id = "a8F3k9Zq7Lm2Xw5Rt1", "AKIA" + "B" * 16
    rows = [(1, f"{id} then {key}"), (2, f"only {key}"), (3, f"{id} {'x ' * 300} {key}"), (4, f"https://h.example/p {id}"), (5, "token= secret=\"abcdefghij\""), (6, None)]
    got = {r.doc_id: secrets_of(r) for r in secrets.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: ["candidate"], 2: [], 3: [], 4: ["endpoint"], 5: [], 6: []}
    docs = spark.createDataFrame([(1, f"é {id}!", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [(r.text, r.n_chars) for r in secrets.redact(docs).collect()] == [("é [access]!", 11)]


def test_long_candidates_are_whole(spark):
    id, long = "AKIA" + "C" * 16, "q" * 70 + "7z" * 35
    rows = [(1, f"{id} {long}"), (2, f"{long[::-1]} {id}"), (3, f"{id} {'q' * 90}"), (4, f"{id} {'a-' * 40}")]
    got = {r.doc_id: [(secrets.KINDS[s.kind], s.end - s.start) for s in r.links] for r in secrets.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [("candidate", 140)], 2: [("candidate", 140)], 3: [], 4: []}


def secrets_of(row):
    return sorted(secrets.KINDS[s.kind] for s in row.links)


def test_ablations_read_the_ledger(spark):
    led = spark.createDataFrame([(0,), (1,), (3,), (2,), (4,)], "failed long")
    got = {(r.policy, r.rule): (r.documents, r.rejected, r.fails, r.only_this) for r in quality.ablations(led).collect()}
    assert got[("base", "few_words")] == (5, 3, 2, 1) and got[("v1", "symbols")] == (5, 4, 1, 1)


def test_shortages_go_to_siblings_first(spark):
    leaves = [("a", "en", "p", 10), ("a", "en", "q", 1000), ("b", "en", "r", 1000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    got = {r.source: r.budget for r in mixing.budgets(df, budget=400, epochs=1, weights={}).collect()}
    assert got == {"p": 10, "q": 190, "r": 200}


OPERATORS = {
    "mix": lambda d: mixing.mixed_documents(d),
    "licenses": lambda d: licenses.scan(d),
    "ledger": lambda d: quality.ledger(d),
    "secrets": lambda d: secrets.redact(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_untidy_and_empty_tables(spark, untidy, name):
    rows = OPERATORS[name](untidy).collect()
    assert len(rows) == len(UNTIDY) if name != "mix" else rows
    assert OPERATORS[name](untidy.limit(0)).collect() == []


def test_empty_tables(spark, untidy):
    none = untidy.limit(0)
    assert near.near_duplicates(none).count() == packing.pack(none).count() == scoring.score(none).count() == 0
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<float>"), lambda i: i == 0).count() == 0


def test_pipeline_stages(spark, untidy):
    docs = untidy
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = out
    kept = {r.doc_id for r in docs.select("doc_id").distinct().collect()}
    assert kept == {1, 6, None}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_pipeline_stages_keep_columns_with_clashing_names(spark, untidy):
    own = {"n_words": "a", "failed": "b", "bucket": "c", "salt": "d", "r_id": "e", "__digest": "f", "component_id": "g", "h": "h", "place": "i", "id": "j"}
    docs = untidy.withColumns({k: F.concat(F.lit(v), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for k, v in own.items()})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        rows = out.collect()
        assert rows
        for r in rows:
            key = "-" if r.doc_id is None else str(r.doc_id)
            assert all(r[k] == v + key for k, v in own.items()), name


def test_every_training_text_trains_the_model(spark):
    """Not a share of the texts: each of a few single texts moves the parameters."""
    start = scoring.Model(np.zeros(scoring.IDS)).vector()
    for i in range(3):
        docs = spark.createDataFrame([(f"only text number {i} " * 20, False)], "text string, held boolean")
        assert not np.array_equal(scoring.train(docs, wordbpe.default_path()).vector(), start)


def test_texts_are_read_once_for_all_steps(spark, untidy):
    """Hashes and ids of every text are written once; the shards hold each different training text once."""
    docs = untidy.select(F.col("doc_id").cast("long").alias("id"), "text").withColumn("held", scoring.held_out(F.col("id")))
    kept_back = docs.withColumn("held", F.lit(True))  # the same texts, met first where they are not trained on
    docs = kept_back.unionByName(docs).unionByName(docs).coalesce(1)
    known = wordbpe.WordEncoder(wordbpe.default_path())
    ids = lambda t: [j for w in common.words((t or "").encode()) for j in known.encode(w.decode("utf-8", "replace"))] + [scoring.END]
    raw = lambda t: np.array(ids(t), dtype="<u2").tobytes()
    read, given = scoring.tokens(docs, wordbpe.default_path()), docs.collect()
    got = Counter((r.id, r.held, bytes(r.words), bytes(r.ids)) for r in read.where("ids IS NOT NULL").collect())
    hashes = lambda t: np.array([*map(xxhash.xxh3_64_intdigest, common.words((t or "").encode())), 1], dtype="<u8").tobytes()
    assert got == Counter((r.id, r.held, hashes(r.text), raw(r.text)) for r in given)
    dealt = [bytes(x) for r in scoring.shards(read).collect() for x in r.texts]
    assert sorted(dealt) == sorted(raw(t) for t in {r.text or "" for r in given if not r.held})


def test_gradient_of_the_attention():
    """Every kind of parameter against differences of the loss, over windows at the start and inside of texts."""
    rng = np.random.default_rng(4)
    model = scoring.Model(rng.integers(1, 50, scoring.IDS).astype(float))
    model.p = {k: v * 3 for k, v in model.p.items()}
    inputs, pad, goal, real, _ = scoring.windows([rng.integers(0, 300, n) for n in (5, 40, 61)], model)

    def loss():
        got = model.score(inputs, pad, goal).astype(np.float64) - model.within[goal.ravel()]
        return -(got * real.ravel()).sum() / real.sum()

    grads = {k: v.copy() for k, v in model.gradient(inputs, pad, goal, real).items()}
    for k, g in grads.items():
        way = rng.normal(size=g.shape).astype(np.float32) * (g != 0)
        at, step = model.p[k], 1e-2 / np.linalg.norm(way)
        model.p[k] = (at + step * way).astype(np.float32)
        up = loss()
        model.p[k] = (at - step * way).astype(np.float32)
        slope = (up - loss()) / (2 * step)
        model.p[k] = at
        assert slope == pytest.approx(float((g * way).sum()), rel=0.03, abs=3e-3), k
