"""Every registered query over its whole tables, against SQL or against a plain Python version."""

import hashlib
import math
import os
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest

import corpus_pipeline
from flowops.llm import oracle, queries
from test_cases import resample_brute

QUERIES, ORACLE = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def result(spark, sf_dir):
    held = {}

    def of(name):
        if name not in held:
            held[name] = [r.asDict() for r in QUERIES[name](spark, sf_dir).collect()]
        return held[name]

    return of


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(result, duck, name):
    got = result(name)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(got[0]) == sorted(columns)
    key = lambda row: tuple((v is not None, v if v is not None else 0) for v in row)
    assert sorted(([r[c] for c in columns] for r in got), key=key) == sorted((list(r) for r in cursor.fetchall()), key=key)


def test_toxicity_on_held_out_rows(result, duck):
    rows = {r["doc_id"]: r for r in result("op2_toxicity")}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())


def test_token_counts_equal_the_library(result, texts):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in result("op5_token_counts"):
        text = texts[r["doc_id"]]
        assert r["n_bytes"] == len(text.encode())
        assert r["n_tokens"] == len(model.encode(text))
        assert r["over_limit"] == (r["n_tokens"] > 4096)
    assert len(result("op5_token_counts")) == len(texts)


def test_chat_reads_back_its_source(result, duck):
    turns = defaultdict(list)
    for conv, role, text in duck.execute("SELECT conv_id, role, coalesce(text, '') FROM conversations ORDER BY conv_id, turn").fetchall():
        turns[conv].append((role, text))
    own = "</s>[INST] ok [/INST]"
    turns[-1] = [("user", own), ("assistant", own)]
    got = {r["conv_id"]: r for r in result("op6_chat_format")}
    assert set(got) == set(turns)
    for conv, rows in turns.items():
        loss = "".join(t for role, t in rows if role == "assistant")
        assert got[conv]["n_turns"] == len(rows)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss)
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[conv]["formatted_chars"] > sum(len(t) for _, t in rows)


def test_fingerprints_and_edited_texts(result, texts):
    order = sorted(texts, reverse=True)
    got = {r["doc_id"]: r for r in result("op7_simhash")}
    assert set(got) == set(order)
    bits = lambda f: int(f, 16)
    near = lambda a, b: 1 - (bits(a) ^ bits(b)).bit_count() / 128
    for i, doc in enumerate(order):
        text, following = texts[doc], order[(i + 1) % len(order)]
        half = len(text) // 2
        edited = text[: len(text) - half] + texts[following][:half]
        row = got[doc]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == near(row["fingerprint"], row["edited_fingerprint"])
        assert row["near_next"] == near(row["fingerprint"], got[following]["fingerprint"])
    by_text = defaultdict(set)
    for doc, row in got.items():
        by_text[texts[doc]].add(row["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())
    prints = [bits(r["fingerprint"]) for r in got.values()]
    for doc, row in got.items():
        own = bits(row["fingerprint"])
        want = sum((own ^ other).bit_count() <= 3 for other in prints) - 1 if doc % 20 == 0 else None
        assert row["n_near"] == want
    mean = lambda name: sum(r[name] for r in got.values()) / len(got)
    assert mean("near_edited") > mean("near_next") + 0.1


def test_packing_places_every_token_once(result, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences, total = defaultdict(list), defaultdict(list), 0
    for r in result("op8_best_two_fit"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, text in texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        own = sorted(pieces.pop(doc), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert sum(r["length"] for r in own) == len(ids)
        assert all(r["length"] == 1024 for r in own[1:])
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
        total += len(ids)
    assert not pieces
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(sequences) <= math.ceil(total / 1024) * 1.03 + 1


def test_shards(result, texts):
    rows = result("op10_hash_tree_shards")
    assert {r["doc_id"] for r in rows} == set(texts)
    slots = defaultdict(list)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "key")
        assert r["grown_shard"] in (r["shard"], 8)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_resampling_equals_brute_force(result, duck):
    docs = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    target = [t for (t,) in duck.execute("SELECT text FROM benchmark").fetchall()]
    want = resample_brute(docs, target)
    got = sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in result("op12_importance_resampling")), key=str)
    assert got == sorted(((d, f, w, s, r) for d, _, f, w, s, r in want), key=str)


def test_languages_of_held_out_rows(result, duck):
    truth = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = {r["doc_id"]: r for r in result("op13_language_id")}
    assert set(rows) == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in rows.items())
    held = [i for i in rows if rows[i]["held_out"]]
    assert sum(rows[i]["lang_pred"] == truth[i] for i in held) >= 0.9 * len(held)


def test_mix_reaches_its_targets(result):
    by_source = defaultdict(list)
    for r in result("op4_curriculum_mix"):
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source[r["source_size"], r["target"]].append(r)
    for (size, target), rows in by_source.items():
        taken, largest = sum(r["taken"] for r in rows), max(r["size"] for r in rows)
        assert abs(taken - target) <= largest and target <= 2 * size
    sizes = sum(r["size"] for rows in by_source.values() for r in rows)
    assert math.isclose(sum(t for _, t in by_source), 1.5 * sizes, rel_tol=1e-9)


def test_pipeline_stages(spark, sf_dir, texts):
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "minhash_dedup", "curriculum_mix", "best_two_fit"]
    before = docs.cache()
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, sf_dir).cache()
        if name != "best_two_fit":
            assert after.dtypes == docs.dtypes
        old, new = ({r["doc_id"] for r in df.select("doc_id").collect()} for df in (before, after))
        assert new <= old
        if name == "line_dedup":
            assert new == old
        if name == "best_two_fit":
            assert new == old
        before = after
    counts = Counter(r["doc_id"] for r in after.where("piece = 0").collect())
    assert counts and max(counts.values()) <= 2


def test_pipeline_rows_stage_by_stage(spark, sf_dir, tmp_path):
    """What each stage keeps, against SQL or a plain version over that stage's own input."""
    import duckdb
    from tokenizers import Tokenizer

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))

    def rows_by_sql(name, path):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        cursor = con.execute(ORACLE[name])
        columns = [c[0] for c in cursor.description]
        return {r[columns.index("doc_id")]: dict(zip(columns, r)) for r in cursor.fetchall()}

    def run(name, given):
        path = str(tmp_path / name)
        stages[name](spark, given, sf_dir).write.parquet(path)
        return spark.read.parquet(path), path

    scores = {r["doc_id"]: r["score"] for r in QUERIES["op2_toxicity"](spark, sf_dir).collect()}
    clean, clean_path = run("toxicity", docs)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, s in scores.items() if s < 0.5}

    lined, lined_path = run("line_dedup", clean)
    want = rows_by_sql("op3_line_dedup", clean_path)
    got = {r["doc_id"]: r for r in lined.collect()}
    assert set(got) == set(want)
    for doc, w in want.items():
        assert hashlib.sha256((got[doc]["text"] or "").encode()).hexdigest() == w["kept_sha256"]
        assert not w["n_dropped"] or got[doc]["n_chars"] == len(got[doc]["text"])

    single, single_path = run("minhash_dedup", lined)
    want = rows_by_sql("op1_minhash_dedup", lined_path)
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(d for d, w in want.items() if w["kept"])

    mix, _ = run("curriculum_mix", single)
    want = rows_by_sql("op4_curriculum_mix", single_path)
    uses = Counter(r["doc_id"] for r in mix.collect())
    assert all(uses[d] * w["size"] == w["taken"] for d, w in want.items())

    sequences, _ = run("best_two_fit", mix)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in mix.collect()}
    pieces, ends = defaultdict(list), defaultdict(list)
    for r in sequences.collect():
        pieces[r["doc_id"], r["use"]].append(r)
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == {(d, u) for d, n in uses.items() for u in range(n)}
    for (doc, _), own in pieces.items():
        ids = [i for r in sorted(own, key=lambda r: r["piece"]) for i in r["ids"]]
        assert ids == [*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 2]
    for places in ends.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 1024


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, "en", None, None), (None, "a b c", None, "s", 5), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "word " * 4000, "de", "t", 20000)],
])
def test_pipeline_of_odd_tables(spark, sf_dir, rows):
    """Nulls, empty and long texts, repeated rows, an empty table and a column whose name the operators use."""
    kind = "doc_id long, text string, lang string, source string, n_chars long, size int"
    docs = spark.createDataFrame([(*r, 7) for r in rows], kind)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir).cache()
        if name != "best_two_fit":
            assert after.dtypes == docs.dtypes
            if name in ("toxicity", "line_dedup"):
                assert after.count() == len(rows)
        docs = after
    lengths = docs.groupBy("sequence_id").sum("length").collect()
    assert all(r[1] <= 1024 for r in lengths) and bool(lengths) == bool(rows)
