"""Token files, the language model and the pipeline."""

import inspect
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from orefold.llm import pseudo_lm, token_files
from orefold.llm import words as word_module
from orefold.llm.queries import TOKENIZER
from orefold.llm.words import text_buffers, words
from orefold.session import scratch_path

from . import brute
from .conftest import SMALL, by_id


@pytest.fixture(scope="module")
def direct():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected_tokens(direct, rows):
    """In ascending id order: (doc_id, start, n_tokens, crc)."""
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: r[0]):
        ids = [*direct.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


ODD_WORDS = [
    (2001, "a\x01b \x01 c"), (2002, "\x01\x01 x"), (2003, "it's <|endoftext|> ok<|endoftext|>z"), (2004, "é ́a"),
    (2005, "Σας ΣΑΣ.  x　y İI ǅ"), (2006, "123 4a5 — “q” 漢字 🙂"),
]


def test_token_files_equal_direct_encoding(spark, documents, given, odd_rows, direct):
    rows = given[:80] + [r for r in odd_rows if r[0] != 1006] + ODD_WORDS
    df = token_files.token_files(spark, documents(rows).repartition(3), tokenizer=TOKENIZER, end_id=1)
    assert by_id(df, "start", "n_tokens", "ids_crc32") == sorted(expected_tokens(direct, rows), key=repr)


def test_the_query_covers_the_table(spark, given, direct):
    df = contract.queries()["op4_token_files"](spark, SMALL)
    assert by_id(df, "start", "n_tokens", "ids_crc32") == sorted(expected_tokens(direct, given), key=repr)


def test_repeated_null_and_no_ids(spark, documents, direct):
    df = token_files.token_files(spark, documents([(3, "b b"), (3, "b b"), (None, "a")]), tokenizer=TOKENIZER, end_id=1)
    assert [r["start"] for r in df.orderBy("start").collect()] == [0, 2, 5]
    assert df.filter("doc_id is null").first()["start"] == 0
    assert token_files.token_files(spark, documents([]), tokenizer=TOKENIZER, end_id=1).count() == 0


def test_shuffled_reads_and_damage(spark, documents, given, direct):
    folder = scratch_path(spark, "files")
    shards = token_files.write_token_files(documents(given[:30]), folder, tokenizer=TOKENIZER, end_id=1).collect()
    shard, n = shards[0]["shard"], shards[0]["n_docs"]
    order = list(range(n))
    random.Random(1).shuffle(order)
    in_order = list(token_files.read_shard(folder, shard))
    texts = dict(given)
    for place, (doc_id, _, _, ids) in zip(order, token_files.read_records_at(folder, shard, order)):
        assert doc_id == in_order[place][0]
        assert ids.tolist() == [*direct.encode(texts[doc_id], add_special_tokens=False).ids, 1]
    path = token_files.open_folder(folder)[1] + f"/{shard:06d}.rec"
    data = bytearray(open(path, "rb").read())
    data[30] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError, match="damaged"):
        list(token_files.read_shard(folder, shard))


def test_words_share_the_work_of_their_letters(direct):
    encode, dtype, cut = token_files.json_tokenizer(TOKENIZER, 1)
    asked = []

    def watched(words):
        asked.extend(words)
        return encode(words)

    known = token_files.Memory(cut)
    known.learn({b"Lorem,", b"lorem.", b"LOREM", b"lorem"}, watched)
    known.learn({b"Lorem", b"loreM.,"}, watched)
    assert sorted(asked) == [",", ".", ".,", "lorem"]
    odd = """It's don't, I'LL'S 'tis É, ÉA... ÀB×c Ñ÷ İ, I\u0307, J\u030c, j\u030c. H\u0331! Ab\u0301, ab1, A12,3 ß? ª. µM/
        <|STARTOFTEXT|> <|startoftext|>, ab<|endoftext|> AB<|ENDOFTEXT|>, ΣΑΣ. ǅ, 漢字, _a_ a_ A'' a'S a"'s" \x01a a\x01 A\u2028b, Ẅ-"""
    texts = [odd, odd.lower(), odd.upper(), odd.swapcase()]
    made = token_files.encoded((t.encode() for t in texts), encode, dtype, 1, known)
    for text, ids in zip(texts, made, strict=True):
        assert np.frombuffer(ids, dtype).tolist() == [*direct.encode(text, add_special_tokens=False).ids, 1]


# --- language model ---------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(1)
    flat = pseudo_lm.Network.initial(np.ones(4096)) + rng.normal(0, 0.05, pseudo_lm.Network.size())
    context, target = rng.integers(0, 4097, (50, 4)), rng.integers(0, 4096, 50)
    before = pseudo_lm.Network(flat).log_probabilities(context, target).mean()
    network = pseudo_lm.Network(flat)
    for _ in range(30):
        network.train(context, target, 0.05)
    assert network.log_probabilities(context, target).mean() > before + 1


def test_probabilities_sum_to_one():
    network = pseudo_lm.Network(pseudo_lm.Network.initial(np.arange(4096)[::-1]))
    context = np.tile([[1, 2, 3, 4096]], (4096, 1))
    assert abs(np.exp(network.log_probabilities(context, np.arange(4096))).sum() - 1) < 1e-3


def test_the_model_prefers_text_to_shuffled_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text")
    vocabulary, flat = pseudo_lm.train_network(docs, rounds=3)
    network = pseudo_lm.Network(flat)

    def score(texts):
        tokens = words(*text_buffers(pa.array(texts)), 0, len(texts))
        ids = vocabulary(tokens.hashes(lower=True))
        context = pseudo_lm._contexts(ids, tokens.text, np.arange(len(ids)))
        return network.log_probabilities(context, ids).mean()

    rng = random.Random(0)
    plain = [r[0] for r in docs.limit(150).collect()]
    mixed = [" ".join(rng.sample(t.split(), len(t.split()))) for t in plain]
    assert score(plain) > score(mixed) + 0.03


def test_scores_equal_plain_loops(documents, given, odd_rows, monkeypatch):
    rows = given[:12] + [r for r in odd_rows if r[0] < 1010]
    texts = [brute.WORD.findall((t or "").translate(brute._SMALL)) for _, t in rows]
    counts = Counter(w for own in texts for w in own)
    names = sorted(counts, key=lambda w: (-counts[w], w))
    hashes = dict(zip(names, words(*text_buffers(pa.array(names)), 0, len(names)).hashes(lower=True).tolist()))
    known = {hashes[w]: i for i, w in enumerate(names[:60])}
    flat = pseudo_lm.Network.initial(np.arange(4096)[::-1]) + np.random.default_rng(4).normal(0, 0.3, pseudo_lm.Network.size())
    vocabulary = pseudo_lm.Vocabulary.of(np.array([hashes[w] for w in names[:60]], np.uint64))
    monkeypatch.setattr(pseudo_lm, "train_network", lambda *_, **__: (vocabulary, flat))

    p = pseudo_lm.Network(flat).p

    def log_softmax(values):
        values = values.astype(np.float64)
        return values - values.max() - np.log(np.exp(values - values.max()).sum())

    def number(word):
        return known.get(hashes[word], 3584 + hashes[word] % 512)

    def score(own):
        total = 0.0
        for i, word in enumerate(own):
            near = [number(own[i + o]) if 0 <= i + o < len(own) else 4096 for o in (-2, -1, 1, 2)]
            h = np.tanh(np.concatenate([p["embedding"][n] for n in near]) @ p["hidden"] + p["hidden_bias"])
            k, m = divmod(number(word), 64)
            total += log_softmax(h @ p["classes"] + p["class_bias"])[k]
            total += log_softmax(h @ p["members"][k] + p["member_bias"][k])[m]
            if hashes[word] not in known:
                bucket = [counts[w] for w in names[60:] if hashes[w] % 512 == hashes[word] % 512]
                total += math.log(counts[word] / (sum(bucket) + 1))
        return total

    got = sorted((r["doc_id"], r["log_likelihood"]) for r in pseudo_lm.pseudo_likelihood(documents(rows)).collect())
    expected = sorted((i, score(own)) for (i, _), own in zip(rows, texts))
    assert [i for i, _ in got] == [i for i, _ in expected]
    assert all(abs(a - b) < 1e-3 + 1e-5 * abs(b) for (_, a), (_, b) in zip(got, expected))


def test_scores_of_odd_rows(spark, documents, given, odd_rows):
    rows = given[:50] + odd_rows
    out = pseudo_lm.pseudo_likelihood(documents(rows)).collect()
    assert len(out) == len(rows)
    counts = sorted((r["doc_id"], r["n_words"]) for r in out)
    assert counts == sorted((i, len(brute.WORD.findall(t or ""))) for i, t in rows)
    for r in out:
        assert (r["log_likelihood"] == 0 and r["per_word"] is None) if r["n_words"] == 0 else r["log_likelihood"] < 0
    assert pseudo_lm.pseudo_likelihood(documents([])).count() == 0
    assert contract.queries()["op6_pseudo_likelihood"](spark, SMALL).count() == len(given)


def test_the_rounds_mask_every_word():
    hashes = np.random.default_rng(3).integers(0, 2**63, 5000).astype(np.uint64)
    place = np.arange(5000, dtype=np.uint64)
    for percent, rounds in ((50, 2), (25, 4), (20, 5)):
        times = sum(pseudo_lm._masked(hashes, place, percent, r).astype(int) for r in range(rounds))
        assert (times == 1).all()
    defaults = inspect.signature(pseudo_lm.pseudo_likelihood).parameters
    assert defaults["rounds"].default * defaults["percent"].default >= 100


def test_words_of_a_bucket_share_its_probability(documents):
    names = [f"w{i}" for i in range(6000)]
    hashes = words(*text_buffers(pa.array(names)), 0, len(names)).hashes(lower=True)
    rare = names[3600:]
    buckets = dict(zip(names, (hashes % np.uint64(512)).tolist()))
    first = rare[0]
    second = next(w for w in rare[1:] if buckets[w] == buckets[first])
    # Rows 0 to 5999 are one word each; `second` occurs twice, `first` once.
    rows = list(enumerate(names)) + [(6000, second), (6001, " ".join(names[:3600] * 4))]
    got = {r["doc_id"]: r["log_likelihood"] for r in pseudo_lm.pseudo_likelihood(documents(rows)).collect()}
    at = {w: i for i, w in enumerate(names)}
    assert abs(got[at[second]] - got[at[first]] - np.log(2)) < 2e-4
    assert got[6000] == got[at[second]]
    assert 0.5 < sum(np.exp(got[i]) for i in range(6000)) <= 1


# --- pipeline ---------------------------------------------------------------


def test_stages(spark, given, direct):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, texts = docs.columns, dict(given)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != "token_output":
            assert out.columns == columns
        path = scratch_path(spark, f"test-{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = [r[0] for r in docs.select("doc_id").collect()]
    base = {i for i, t in given if brute.base_counts(t)[0] >= 50 and 2 * brute.base_counts(t)[4] <= brute.base_counts(t)[0]}
    assert set(kept["quality"]) <= base
    groups = brute.near_components([(i, texts[i]) for i in kept["quality"]], 5)
    assert sorted(kept["near_dedup"]) == sorted(i for i in groups if groups[i][1] == i)
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = set(brute.leaks([(i, texts[i]) for i in kept["near_dedup"]], items))
    assert sorted(kept["decontaminate"]) == sorted(set(kept["near_dedup"]) - leaked)
    assert set(kept["mix"]) <= set(kept["decontaminate"]) and max(map(kept["mix"].count, kept["mix"])) <= 3
    expected = expected_tokens(direct, [(i, texts[i]) for i in kept["mix"]])
    assert by_id(docs, "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_the_pipeline_takes_odd_rows(spark, documents, odd_rows):
    rows = [*odd_rows, (None, "null id " * 3 + " ".join(f"w{i}" for i in range(90)))]
    docs = documents(rows)
    for name, stage in corpus_pipeline.STAGES:
        for frame in (docs, docs.limit(0)):
            out = stage(spark, frame, SMALL)
            if name != "token_output":
                assert out.columns == docs.columns
            out.collect()


def test_a_step_takes_all_classes_at_once_and_is_that_of_plain_gradients(monkeypatch):
    rng = np.random.default_rng(3)
    flat = pseudo_lm.Network.initial(np.arange(4096)[::-1]) + rng.normal(0, 0.3, pseudo_lm.Network.size())
    context, target = rng.integers(0, 4097, (500, 4)), rng.integers(64, 4096, 500)  # no word of class 0
    calls, softmax = [], pseudo_lm._softmax
    monkeypatch.setattr(pseudo_lm, "_softmax", lambda logits: calls.append(len(logits)) or softmax(logits))
    network = pseudo_lm.Network(flat)
    network.train(context, target, 0.05)
    assert calls == [500, 500]
    p = {name: value.astype(float) for name, value in pseudo_lm.Network(flat).p.items()}
    gradients = {name: np.zeros(value.shape) for name, value in p.items()}
    for words, word in zip(context, target):
        c, m = divmod(int(word), 64)
        x = p["embedding"][words].ravel()
        h = np.tanh(x @ p["hidden"] + p["hidden_bias"])
        errors = []
        for logits, at in ((h @ p["classes"] + p["class_bias"], c), (h @ p["members"][c] + p["member_bias"][c], m)):
            share = np.exp(logits - logits.max())
            share /= share.sum()
            share[at] -= 1
            errors.append(share / len(target))
        outer, inner = errors
        back = (p["classes"] @ outer + p["members"][c] @ inner) * (1 - h * h)
        gradients["classes"] += np.outer(h, outer)
        gradients["class_bias"] += outer
        gradients["members"][c] += np.outer(h, inner)
        gradients["member_bias"][c] += inner
        gradients["hidden"] += np.outer(x, back)
        gradients["hidden_bias"] += back
        np.add.at(gradients["embedding"], words, (p["hidden"] @ back).reshape(4, -1))
    for name, gradient in gradients.items():
        expected = p[name] - 0.05 * gradient / np.sqrt(1e-6 + gradient * gradient)
        assert np.abs(network.p[name] - expected).max() < 1e-4, name
    assert (network.p["members"][0] == pseudo_lm.Network(flat).p["members"][0]).all()


def test_only_places_of_infrequent_words_are_joined(documents, monkeypatch):
    names = [f"w{i}" for i in range(4200)]
    hashes = words(*text_buffers(pa.array(names)), 0, len(names)).hashes(lower=True)
    model = pseudo_lm.Vocabulary.of(hashes[:3584]), pseudo_lm.Network.initial(np.arange(4096)[::-1])
    monkeypatch.setattr(pseudo_lm, "train_network", lambda *_, **__: model)
    # 516 words occur once, 60 three times in two texts, 40 nine times in one.
    rows = [(0, " ".join(names[:4000] + names[4001:4100])), (1, " ".join(names[4100:4160] * 2))]
    rows += [(2, " ".join(names[4100:4160])), (3, " ".join(names[4160:] * 9)), (4, None), (5, names[4000])]
    joined, inside = [], pseudo_lm._inside

    def spied(places, *rest):
        joined.append(places.count())
        return inside(places, *rest)

    monkeypatch.setattr(pseudo_lm, "_inside", spied)
    scores = []
    for most in (0, 70, 200, 10_000):
        monkeypatch.setattr(pseudo_lm, "_SHARED", most)
        out = pseudo_lm.pseudo_likelihood(documents(rows)).collect()
        scores.append([r["log_likelihood"] for r in sorted(out)])
    assert joined == [516 + 120 + 40, 516 + 120, 516, 0]
    assert all(abs(a - b) < 2e-4 for other in scores[1:] for a, b in zip(scores[0], other, strict=True))


def test_words_are_hashed_by_blocks(monkeypatch):
    texts = ["", "a bc  def", None, "x" * 500, " ", *["Some words é " * 40] * 3, "", "end"]
    data, offsets = text_buffers(pa.array(texts))
    taken, whole = [], word_module.PrefixHashes
    monkeypatch.setattr(word_module, "PrefixHashes", lambda data, *rest: taken.append(len(data)) or whole(data, *rest))
    monkeypatch.setattr(word_module, "_HASH_BLOCK", 64, raising=False)
    for find in (words, word_module.lines):
        tokens = find(data, offsets, 0, len(texts))
        got = tokens.hashes(lower=True)
        assert (got == whole(tokens.data, True)(tokens.start, tokens.end)).all()
        longest = (tokens.end - tokens.start).max()
        assert max(taken) <= 64 + longest and len(got) == len(tokens.text) == tokens.counts.sum()
        taken.clear()
        owners = [i for i, n in enumerate(tokens.counts) for _ in range(n)]
        assert tokens.text.tolist() == owners
        assert all(offsets[i] <= a <= b <= offsets[i + 1] for i, a, b in zip(owners, tokens.start, tokens.end))
        assert len(find(data, offsets, 0, 1).hashes()) == (find is not words)


def test_softmaxes_of_near_and_far_logits():
    plain = np.random.default_rng(5).normal(0, 3, (4, 64))
    far = plain + np.array([[0], [200], [-300], [1000]])
    column = np.array([0, 5, 63, 7])
    for logits in (plain, far):
        share = np.exp(logits - logits.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        assert np.abs(pseudo_lm._softmax(logits.astype(np.float32)) - share).max() < 1e-4
        found = pseudo_lm._log_softmax_at(logits.astype(np.float32), column)
        assert np.abs(found - np.log(share[np.arange(4), column])).max() < 1e-3
