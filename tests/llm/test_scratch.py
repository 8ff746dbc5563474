"""What operators leave on the disk and hold in a task."""

import os
import time
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from flowops.llm import lines, minhash, packing, toxicity, words
from flowops.llm.common import CLEANUP, stored
from flowops.session import shared_dir


def shuffled(spark):
    """Bytes of shuffle files of the session."""
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {p: p.stat().st_size for d in dirs for p in Path(d.getPath()).rglob("shuffle_*.data")}


def test_shuffles_of_a_stored_table_leave_the_disk(spark):
    before, set_ = shuffled(spark), spark.conf.get(CLEANUP)
    table = stored(spark.range(200_000).groupBy(F.xxhash64("id").alias("k")).count(), "test-shuffle")
    end = time.time() + 20
    while set(shuffled(spark)) - set(before) and time.time() < end:
        time.sleep(0.2)
    assert not set(shuffled(spark)) - set(before)
    assert table.count() == 200_000 and spark.conf.get(CLEANUP) == set_


def test_whole_counts_leave_the_shared_folder(spark):
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(os.listdir(folder))
    rows = [(f"p{i % 9} plain{i % 5} words " + "bad worse " * (i % 3 == 0), int(i % 3 == 0)) for i in range(300)]
    known = spark.createDataFrame(rows, "text string, toxic long")
    assert toxicity._evidence(known, known.select("text")).count()
    left = {n.removeprefix("flowops-").rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before}
    assert "toxic-evidence" in left and not left & {"toxic-words", "toxic-pairs", "toxic-runs"}


def test_lookups_of_few_keys_are_small():
    held = toxicity.Lookup(np.arange(9, dtype=np.uint64) << np.uint64(60), np.ones(9, np.float32))
    assert sum(x.nbytes for x in vars(held).values()) < 4 << 20


def test_short_texts_are_counted_together():
    batches = [pa.RecordBatch.from_arrays([pa.array([b"w%07d" % j for j in range(i, i + 1000)], pa.binary())], names=["text"]) for i in range(0, 200_000, 1000)]
    got = list(toxicity._together(iter(batches)))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches(batches))
    assert len(got) < 8 and all(b.nbytes < 3 * words.SLICE for b in got)


def left_by(spark, made):
    """Tables that a result leaves in the shared folder."""
    folder = Path(shared_dir(spark).removeprefix("file://"))
    before = set(os.listdir(folder))
    assert made().count()
    return {n.removeprefix("flowops-").rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before if n.startswith("flowops-")}


def test_tables_of_the_deduplications_leave_the_shared_folder(spark, docs):
    same = " ".join(f"word{i}" for i in range(60))
    rows = docs([(i, f"a line that all of these documents hold\n{same} {i}") for i in range(40)])
    assert left_by(spark, lambda: lines.line_dedup(rows)) == {"line-losses"}
    assert left_by(spark, lambda: minhash.near_duplicates(rows)) == {"near-duplicates"}


def test_ids_of_moved_pieces_take_two_bytes(spark, docs):
    rows = docs([(i % 7, f"text {i % 3} " * 900) for i in range(30)])
    cut = packing.pieces_of(rows, with_ids=True)
    assert all(len(r["ids"]) == 2 * r["length"] for r in cut.select("ids", "length").collect())
    # Equal pieces of a doc_id are told apart in the order of their places; the ids come back whole.
    got = packing.best_two_fit(rows, with_ids=True, with_uses=True).collect()
    equal = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        equal[r["doc_id"], r["piece"], r["length"], r["ids_crc32"]].append(r["use"])
    assert all(uses == list(range(len(uses))) for uses in equal.values()) and max(map(len, equal.values())) > 1


def test_places_of_runs_are_counted_by_few_tasks(spark):
    rows = spark.createDataFrame([(f"w{i}x plain{i % 97}",) for i in range(4000)], "text string")
    found, only = toxicity._all_words(rows), np.full(1 << toxicity.MAP_BITS >> 3, 255, np.uint8)
    counted = toxicity._places(found, only)
    assert "Coalesce" in counted._jdf.queryExecution().toString()
    got = {(r["size"], r["key"]): r["kinds"] for r in counted.collect()}
    want = defaultdict(int)
    for size, _, hashes in words.grams(pa.array(sorted({w.encode() for r in rows.collect() for w in r["text"].split()}), pa.binary()), toxicity.SIZES):
        want[size, None] += len(hashes)
        for key in hashes.view(np.int64).tolist():
            want[size, key] += 1
    assert got == want


def test_most_keys_asked_for_are_met_in_the_first_table():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 1 << 64, 100_000, np.uint64))
    held = toxicity.Lookup(keys, np.arange(1, len(keys) + 1, dtype=np.float32))
    assert (held(keys) == np.arange(1, len(keys) + 1)).all() and not held(rng.integers(0, 1 << 64, 1000, np.uint64)).any()
    first = held.starts[1]
    assert np.isin(keys, held.keys[:first]).mean() > 0.6 and len(held.keys) < 4 * len(keys)


def test_different_numbers_and_where_they_are_first():
    rng = np.random.default_rng(4)
    for x in (np.zeros(0, np.uint64), rng.integers(0, 50, 1000).astype(np.uint64), rng.integers(0, 1 << 60, 1000).astype(np.uint64)):
        for got, want in zip(words.distinct(x), np.unique(x, return_index=True, return_inverse=True)):
            assert (got == want).all()
