"""Prefix trie, web archives and ranked search."""

import io
import random
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as contract
from orefold.llm import lexical, prefix_trie, warc
from orefold.session import scratch_path

from . import brute
from .conftest import SMALL


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- prefix trie ------------------------------------------------------------

NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def talks(spark, rows):
    extra = ["x", "y"]
    schema = "conv_id long, turn long, role string, text string, path string, shard string"
    return spark.createDataFrame([(*r, *extra) for r in rows], schema)


def random_talks(n, seed):
    """Few different turns, so that prefixes are shared a lot; some conversations are equal."""
    rng = random.Random(seed)
    rows = []
    for i in rng.sample(range(-50, 4 * n), n):
        for turn in range(rng.choice((1, 2, 3, 3, 4, 7))):
            rows.append((i, turn, ("user", "assistant")[turn % 2], rng.choice(("hi", "é!", "ok", "")[: 1 + turn % 4])))
    return rows


ODD_TALKS = [
    (1, None, None, None), (1, None, "", ""), (1, 5, "user", "a"), (1, 5, "user", "a"), (1, 5, "user", "A"),
    (None, 0, "user", "nobody"), (2, 0, "us", "er"), (3, 0, "user", ""), (4, 0, "u", "x" * 200_000),
    (5, 0, "user", "漢字\U0001f600"), (6, 0, "user", "漢字\U0001f600"), (100, 3, "user", "late"), (100, 1, "user", "early"),
    (101, 0, "a", "b"), (202, 0, "a", "b"),
]


@pytest.mark.parametrize("shard_turns", [4, 40, 1 << 14])
def test_trie(spark, shard_turns):
    rows = random_talks(300, shard_turns) + [(i + 2000 if i is not None else i, *r) for i, *r in ODD_TALKS]
    got = rows_of(prefix_trie.prefix_trie(talks(spark, rows).repartition(5), shard_turns=shard_turns), *NODE)
    assert got == sorted(brute.trie(brute.dialogues(rows)), key=repr)


def test_conversations_longer_than_a_shard(spark):
    rows = [(i, t, "user", f"w{t if t < 30 else t * i}") for i in (3, 4, 9) for t in range(53)]
    rows += [(5, 0, "user", "w0"), (8, 0, "user", "other")]
    got = rows_of(prefix_trie.prefix_trie(talks(spark, rows), shard_turns=7), *NODE)
    assert got == sorted(brute.trie(brute.dialogues(rows)), key=repr)


def test_rebuilt_trie(spark):
    rows = random_talks(400, 5) + [(i + 5000 if i is not None else i, *r) for i, *r in ODD_TALKS]
    turns, members = prefix_trie.rebuilt_turns(prefix_trie.keyed_turns(talks(spark, rows)))
    got = rows_of(prefix_trie.trie(prefix_trie.shard_nodes(turns, members, shard_turns=50)), *NODE)
    own = brute.rebuilt(brute.dialogues(rows))
    assert got == sorted(brute.trie(own), key=repr)
    assert any(not turns for turns in own.values())


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(talks(spark, [])).count() == 0
    assert prefix_trie.prefix_trie(talks(spark, [(None, 0, "user", "x")])).count() == 0


def test_children_are_intersections_of_bitmaps():
    shard = prefix_trie.Shard([2, 5, 7], [[(b"a", 1), (b"b", 1)], [(b"a", 1), (b"c", 1)], [(b"z", 1)]])
    assert shard.postings[0, b"a"] == 0b011 and shard.postings[1, b"c"] == 0b010 and shard.over[2] == 0b011
    nodes = [(n[4], n[5], n[6], n[9]) for n in shard.nodes()]
    assert nodes == [(0, 2, 3, ""), (1, 2, 2, ""), (2, 2, 1, "2"), (2, 5, 1, "5"), (1, 7, 1, "7")]


# --- web archives -----------------------------------------------------------

PAGE = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pages(spark, rows):
    schema = "page_id long, url string, html string, same string, revisit string, offset string"
    return spark.createDataFrame([(i, u, t, "x", "x", "x") for i, u, t in rows], schema)


ODD_PAGES = [
    (None, None, None), (None, "u r\r\nWARC-Type: evil", "x" * 2000), (7, None, "x" * 2000), (8, "é", "x" * 2000),
    (8, "é", "x" * 2000), (9, "a", ""), (10, "a", "é" * 499 + "a"), (11, "a", "é" * 499 + "a"), (12, "a", "é" * 500),
    (13, "a", "é" * 500), (14, "a", "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (15, "a", "y" * 3_000_000), (3, "a", "y" * 3_000_000),
    (None, "a", "z" * 1000), (None, "b", "z" * 1000),
]


def given_pages(spark):
    found = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url", "html").collect()
    rows = [tuple(r) for r in found]
    return rows + [(i + 1000, u, t) for i, u, t in rows[::3]] + [(i + 2000, u, t) for i, u, t in rows[::6]]


def test_archives_give_the_pages_back(spark):
    rows = given_pages(spark) + ODD_PAGES
    got = rows_of(warc.warc_records(spark, pages(spark, rows).repartition(4)), *PAGE)
    assert got == sorted(brute.archived([(i, t) for i, _, t in rows]), key=repr)
    assert warc.warc_records(spark, pages(spark, [])).count() == 0


def test_payloads_urls_and_single_records(spark):
    rows = given_pages(spark) + ODD_PAGES
    folder = scratch_path(spark, "test-warc")
    blocks = warc.write_archives(pages(spark, rows), folder, archive_bytes=9_000, block_bytes=3_000, sample_bytes=20_000)
    assert blocks.count() > blocks.select("archive").distinct().count() > 4
    read = warc.read_archives(spark, blocks, folder, payloads=True).collect()
    assert len(read) == len(rows)
    responses = {(r["page_id"], bytes(r["payload"])) for r in read if r["record_type"] == "response"}
    assert responses <= {(i, (t or "").encode()) for i, _, t in rows}
    urls = {r["page_id"]: r["url"] for r in read if r["page_id"] is not None}
    assert urls == {i: u for i, u, _ in rows if i is not None}
    assert "u%20r%0D%0AWARC-Type:%20evil" in [r["url"] for r in read]
    ids = [r["record_id"] for r in read if r["page_id"] != 8]
    assert len(set(ids)) >= len(ids) - 1
    for r in random.Random(1).sample(read, 20):
        one = warc.read_record_at(folder, r["archive"], r["offset"])
        assert (one["record_id"], one["payload_digest"]) == (r["record_id"], r["payload_digest"])


@pytest.fixture(scope="module")
def archive():
    """Bytes of an archive, and where its frames begin."""
    held = [warc.page_record(i, "http://a/", b"<p>%d</p>" % i * 50, f"urn:x:{i}", None, "2000-01-01T00:00:00Z") for i in range(40)]
    dictionary = warc.dictionary_of(held, 4096)
    writer = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    data, starts = warc.dictionary_frame(dictionary), []
    for one in held:
        starts.append(len(data))
        data += writer.compress(one)
    return data, starts, held


def read_all(data):
    stream = io.BytesIO(data)
    reader = zstandard.ZstdDecompressor(dict_data=warc.load_dictionary(stream))
    return [(at, one) for at, one in warc.frames(stream, stream.tell(), None, reader)]


def test_frames_and_dictionary(archive, monkeypatch):
    data, starts, held = archive
    assert struct.unpack("<I", data[:4])[0] == 0x184D2A5D
    assert read_all(data) == list(zip(starts, held))
    monkeypatch.setattr(warc, "_READ_BYTES", 3)
    assert read_all(data) == list(zip(starts, held))
    # Other skippable frames are passed over, a plain dictionary serves as well.
    skip = struct.pack("<II", 0x184D2A53, 5) + b"12345"
    assert [one for _, one in read_all(data[: starts[5]] + skip + data[starts[5] :] + skip)] == held
    _, size = struct.unpack("<II", data[:8])
    plain = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
    assert [one for _, one in read_all(struct.pack("<II", 0x184D2A5D, len(plain)) + plain + data[8 + size :])] == held
    without = zstandard.ZstdCompressor().compress(held[0])
    stream = io.BytesIO(without)
    assert warc.load_dictionary(stream) is None
    assert [one for _, one in warc.frames(stream, 0, None, zstandard.ZstdDecompressor())] == held[:1]


def test_damage_is_noticed(archive):
    data, starts, held = archive
    for broken in (
        data[:-3],
        data[:20],
        b"\0" + data[1:],
        data[: starts[3] + 9] + bytes([data[starts[3] + 9] ^ 1]) + data[starts[3] + 10 :],
        data[: starts[7] + 2] + data[starts[7] + 3 :],
    ):
        with pytest.raises(warc.DamagedArchive):
            read_all(broken)
    good = held[4]
    assert warc.page_row(warc.parse_record(good))["page_id"] == 4
    for old, new in (
        (b"WARC/1.1", b"WARC/9.9"),
        (b"WARC-Date", b"X-Date"),
        (b"<p>4", b"<p>5"),
        (b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A"),
        (b"Content-Type: application", b"Content-Length: 3\r\nContent-Type: application"),
        (b"WARC-Type", b"WARC Type"),
    ):
        with pytest.raises(warc.DamagedArchive):
            warc.page_row(warc.parse_record(good.replace(old, new, 1)))
    for cut in (good + b"x", good[:-1], good[:40]):
        with pytest.raises(warc.DamagedArchive):
            warc.parse_record(cut)


def test_a_revisit_needs_its_response(spark):
    folder = scratch_path(spark, "test-warc")
    blocks = warc.write_archives(pages(spark, [(1, "a", "x" * 1500), (2, "a", "x" * 1500)]), folder)
    records = warc.read_archives(spark, blocks, folder)
    assert rows_of(warc.resolved(records), "page_id", "refers_to") == [(1, 2), (2, None)]
    with pytest.raises(Exception, match="revisit without its response"):
        warc.resolved(records.filter("record_type = 'revisit'")).collect()
    with pytest.raises(Exception, match="records instead of"):
        warc.read_archives(spark, blocks.withColumn("n_records", F.col("n_records") + 1), folder).collect()


# --- ranked search ----------------------------------------------------------

RANK = ("item_id", "rank", "doc_id", "score")


def items_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "item_id long, text string, score string")


@pytest.mark.parametrize("block_bytes, query_bytes", [(8 << 20, 4 << 20), (20_000, 500)])
def test_search(spark, documents, given, odd_rows, monkeypatch, block_bytes, query_bytes):
    monkeypatch.setattr(lexical, "_BLOCK_BYTES", block_bytes)
    rows = given + odd_rows + [(None, given[0][1]), (None, "two words"), (-5, "TWO words two")]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    items += [(900, "two words"), (900, "one x1"), (901, None), (902, "!?"), (903, "nowhere at all"), (None, "One é ß"), (904, given[5][1])]
    found = lexical.lexical_search(documents(rows).repartition(3), items_of(spark, items), k=7, query_bytes=query_bytes)
    assert rows_of(found, *RANK) == sorted(brute.ranked(rows, items, 7), key=repr)


def test_the_search_query_covers_the_table(spark, given):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = rows_of(contract.queries()["op13_lexical_search"](spark, SMALL), *RANK)
    assert got == sorted(brute.ranked(given, items, 50), key=repr)


def test_search_of_nothing(spark, documents):
    assert lexical.lexical_search(documents([]), items_of(spark, [(1, "a")])).count() == 0
    assert lexical.lexical_search(documents([(1, "a")]), items_of(spark, [])).count() == 0


def test_accumulators_stay_limited_and_results_exact():
    rng = np.random.default_rng(7)
    n, k = 4000, 10
    # Rare terms weigh much, the last ones are in most documents and weigh little.
    lists = [np.sort(rng.choice(n, size, replace=False)) for size in (15, 20, 30, 2000, 3000, 3900)]
    start = np.cumsum([0, *map(len, lists)])
    postings = lexical.Postings(np.ones(n, np.int64), start, np.concatenate(lists), np.ones(start[-1], np.int64))
    gains = np.concatenate([rng.integers(top // 2, top, len(x)) for x, top in zip(lists, (900, 800, 700, 60, 40, 20))])
    bounds = np.array([gains[a:b].max() for a, b in zip(start, start[1:])])
    full = np.zeros(n, np.int64)
    np.add.at(full, postings.doc, gains)
    doc, score = lexical.best_scores(postings, gains, bounds, list(range(6)), k, 1)
    assert len(doc) < 100 and (score == full[doc]).all()
    order = np.lexsort((np.arange(n), -full))[:k]
    assert set(order) <= set(doc)
    # A floor reached before keeps all from starting; one that can just be reached does not.
    assert len(lexical.best_scores(postings, gains, bounds, list(range(6)), k, int(bounds.sum()) + 1)[0]) == 0
    assert len(lexical.best_scores(postings, gains, bounds, list(range(6)), k, int(bounds.sum()))[0]) > 0
