"""Chunking, ids, batches, hooks and file round trips."""

import hashlib

import pytest
from pyspark.sql import functions as F

from casework.functions import hooks, scalars
from casework.operators import corpus
from casework.schemas import CATEGORIES, INCIDENT_LABEL, SEVERITIES, URGENCY_NOTE_WORDS
from casework.session import scratch_path
from casework.sources import files, sinks


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def reference_chunks(tokens, size, step, keep):
    out, start = [], 0
    while start < len(tokens):
        end = min(start + size, len(tokens))
        text = " ".join(tokens[start:end])
        if keep(text):
            out.append(text)
        if end == len(tokens):
            break
        start += step
    return out


@pytest.mark.parametrize("n", [1, 20, 511, 512, 513, 600, 700, 800, 960, 961, 2000])
def test_chunk_loops_agree(spark, n):
    tokens = [f"word{i}" for i in range(n)]
    df = docs(spark, " ".join(tokens))
    fixed = [r.content for r in corpus.chunk_fixed(df, "doc_id", "text").orderBy("chunk_index").collect()]
    assert fixed == reference_chunks(tokens, 512, 448, lambda t: len(t.strip()) > 50)
    ratio = corpus.chunk_ratio(df, "doc_id", "text").orderBy("chunk_index").collect()
    assert [r.content for r in ratio] == reference_chunks(tokens, 512, 410, lambda t: True)
    assert all(r.token_count == len(r.content.split(" ")) <= 512 and r.total_chunks == len(ratio) for r in ratio)


def test_blank_and_short_texts(spark):
    df = docs(spark, "", "  \t\n ", "One short sentence.")
    assert corpus.chunk_fixed(df, "doc_id", "text").count() == 0
    assert [r.doc_id for r in corpus.chunk_ratio(df, "doc_id", "text").collect()] == [2]


def test_600_words_give_two_chunks_and_overlap_is_exact(spark):
    df = docs(spark, " ".join(f"w{i}" for i in range(600)))
    assert corpus.chunk_fixed(df, "doc_id", "text").count() == 2
    parts = [r.content.split(" ") for r in corpus.chunk_ratio(df, "doc_id", "text", size=100).orderBy("chunk_index").collect()]
    assert all(a[-20:] == b[:20] for a, b in zip(parts, parts[1:-1]))


def test_ids(spark):
    row = spark.range(1).select(
        scalars.chunk_id(F.lit("a/b.txt"), F.lit(3)).alias("sha"), scalars.chunk_id(F.lit("a/b.txt"), F.lit(3), "md5").alias("md5")
    ).first()
    assert row.sha == hashlib.sha256(b"a/b.txt:3").hexdigest()[:32]
    assert row.md5 == hashlib.md5(b"a/b.txt::3").hexdigest()


def test_250_rows_are_three_batches(spark):
    got = []
    for parts in (1, 16):
        df = spark.range(250).repartition(parts)
        out = sinks.write_batches(df, lambda b: int(b["id"].max() - b["id"].min() + 1), ["id"]).collect()
        got.append(sorted((r.batch, r["rows"], r.succeeded) for r in out))
    assert got == [[(0, 100, 100), (1, 100, 100), (2, 50, 50)]] * 2
    assert sinks.write_batches(spark.range(0), len, ["id"]).collect() == []


def test_failing_batch_is_reported(spark):
    def sink(batch):
        if batch["id"].min() == 100:
            raise ValueError("refused")
        return len(batch)

    out = sinks.write_batches(spark.range(250).repartition(5), sink, ["id"]).collect()
    assert sum(r.succeeded for r in out) == 150 and [r.error for r in out if r.error] == ["refused"]


def test_embedding_retries_then_keeps_the_error(spark):
    df = spark.createDataFrame([(i, "bad" if i == 7 else "good") for i in range(10)], "id int, content string").coalesce(1)

    class Flaky:
        calls = 0

        def __call__(self, texts):
            self.calls += 1
            if "bad" in texts:
                raise RuntimeError("429")
            if self.calls == 1:
                raise RuntimeError("once")
            return [[float(len(t))] for t in texts]

    out = {r.id: r for r in hooks.embed(df, fn=Flaky(), batch=5, tries=2, wait=0.0).collect()}
    assert len(out) == 10
    assert out[0].content_vector == [4.0] and out[0].error is None
    assert out[7].content_vector is None and out[7].error == "429"


def test_default_embedding_has_unit_length(spark):
    df = spark.createDataFrame([(1, "alpha beta beta"), (2, "")], "id int, content string")
    got = {r.id: r.content_vector for r in hooks.embed(df).collect()}
    assert sum(x * x for x in got[1]) == pytest.approx(1, abs=1e-5) and not any(got[2])


def test_model_json_is_flagged_never_dropped(spark):
    df = spark.read.schema("id int, output string").json("tests/fixtures/labelled_incidents.json")
    out = scalars.parse_model_json(
        df, "output", INCIDENT_LABEL, {"severity": SEVERITIES, "category": CATEGORIES}, {"urgency_note": URGENCY_NOTE_WORDS}
    )
    got = {r.id: r.p for r in out.select("id", F.col("problems").alias("p")).collect()}
    assert got == {1: [], 2: ["enum:severity"], 3: ["bad_json"], 4: ["missing:regulatory_flag", "long:urgency_note"]}


def test_scan_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a_b-c.TXT").write_bytes(b"caf\xe9 ok")
    (tmp_path / "sub" / "d.txt").write_text("deep")
    (tmp_path / "x.pdf").write_text("no")
    (tmp_path / "_b.txt").write_text("kept \ufffd")
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / ".c.txt").write_text("no")
    for folder in ("_sub/deep", ".git", "sub/.hidden"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "c.txt").write_text("c")
    for path in (str(tmp_path), f"file:{tmp_path}/"):
        got = {r.path: r for r in files.scan_files(spark, path).collect()}
        assert set(got) == {"a_b-c.TXT", "_b.txt", "empty.txt", "sub/d.txt", "_sub/deep/c.txt"}
        assert [got[k].text for k in ("a_b-c.TXT", "_b.txt", "empty.txt")] == ["caf ok", "kept \ufffd", ""]
        assert got["sub/d.txt"].name == "d.txt" and got["sub/d.txt"].size == 4
        assert got["sub/d.txt"].modified.timestamp() == pytest.approx((tmp_path / "sub/d.txt").stat().st_mtime, abs=1)
    assert files.scan_files(spark, str(tmp_path / ".git"), [".md"]).count() == 0
    stored = {r.path: r.text for r in files.scan_store(spark, str(tmp_path)).collect()}
    assert stored == {"a_b-c.TXT": "caf ok", "sub/d.txt": "deep"}
    assert spark.range(1).select(scalars.title_from_path(F.lit("a_b-c.TXT")).alias("t")).first().t == "a b c"


def test_upsert_twice_changes_nothing(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    once = sinks.upsert(old, new, ["id"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, sinks.upsert(once, new, ["id"]).collect())) == sorted(map(tuple, once.collect()))


def test_long_key_continues_in_further_chunks(spark):
    df = spark.range(25).select(F.lit("sku").alias("k"), "id")
    out = corpus.chunk_by_key(df, "k", [F.col("id")], F.col("id").cast("string"), max_lines=10).orderBy("chunk_index").collect()
    assert [r.lines for r in out] == [10, 10, 5]
    assert "\n".join(r.content for r in out).split("\n") == [str(i) for i in range(25)]


def test_eval_set_defaults(spark):
    cases = files.read_eval_set(spark, "tests/fixtures/eval_set.json")
    assert cases.count() == 20
    assert cases.where("should_escalate").count() == 4 and cases.where("is_out_of_scope").count() == 2


def test_csv_names(spark):
    path = scratch_path(spark, "csv-test")
    spark.createDataFrame([(1, "12%")], "` Unit Price (AUD)` int, Discount string").write.option("header", "true").csv(path)
    df = files.read_csv(spark, path)
    assert [c for c in df.columns if "price" in c][0].strip("_") == "unit_price_aud"
    assert df.select(scalars.parse_discount("discount").alias("d")).first().d == pytest.approx(0.12)


def test_prompt_never_fills_braces_of_the_context(spark):
    out = spark.range(1).select(
        scalars.build_prompt("```\n{retrieved_chunks}\nQ: {user_query}\n```", F.lit("text {user_query} end"), F.lit("why?")).alias("p")
    ).first().p
    assert out == "text {user_query} end\nQ: why?"
