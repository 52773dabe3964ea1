"""Near duplicates: SuperMinHash signatures, banding, verification, grouping."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .graph import components, union_find
from .words import chunks, mix, text_buffers, words

# Members per side of one block in which leftover links are looked for.
_BLOCK = 1024
_COLUMNS = 8192


_SET = ["print_a", "print_b"]


def shingle_sets(data, offsets, first: int, last: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of the word shingles per text, and offsets.

    ASCII capitals count as small letters. A text of fewer words than `size`
    has its whole sequence as one shingle, a text without words has none.
    """
    tokens = words(data, offsets, first, last)
    h = tokens.hashes(lower=True)
    ends = np.cumsum(tokens.counts)
    starts = ends - tokens.counts
    left = ends[tokens.text] - np.arange(len(h))  # words from here to the end
    whole = np.minimum(tokens.counts, size)[tokens.text]
    at = np.flatnonzero(left >= whole)
    folded, length = h[at], whole[at]
    for k in range(1, size):
        more = length > k
        folded[more] = mix(folded[more] * np.uint64(0x9FB21C651E98DF25) + h[at[more] + k])
    per_text = np.bincount(tokens.text[at], minlength=tokens.n_texts)
    stops = np.cumsum(per_text)
    begins = stops - per_text
    for a, b in zip(begins.tolist(), stops.tolist()):
        folded[a:b].sort()
    new = np.ones(len(folded), bool)
    new[1:] = folded[1:] != folded[:-1]
    new[begins[per_text > 0]] = True
    of_text = np.repeat(np.arange(tokens.n_texts), per_text)
    sizes = np.bincount(of_text[new], minlength=tokens.n_texts)
    return folded[new], np.concatenate([[0], np.cumsum(sizes)])


def superminhash(sets: np.ndarray, offsets: np.ndarray, length: int) -> np.ndarray:
    """Signatures (texts x length) of non-empty sets.

    Round j gives every element the value j + u at the j-th place of a random
    permutation of the places that belongs to the element (built step by step
    as a Fisher-Yates shuffle); a place keeps its minimum. Permuted ranks make
    the places of one element differ, which lowers the variance. A text is done
    once all its places hold values of the rounds so far, as later ones exceed
    them; most texts need one or two rounds.
    """
    n = len(offsets) - 1
    signature = np.full(n * length, np.iinfo(np.uint64).max, np.uint64)
    text = np.repeat(np.arange(n), np.diff(offsets))
    elements, permutation = sets, None
    for j in range(length):
        random = mix(elements + np.uint64((j + 1) * 0xA0761D6478BD642F % 2**64))
        value = np.uint64(j << 40) | (random >> np.uint64(24))
        k = j + (((random & np.uint64(0xFFFFFF)) * np.uint64(length - j)) >> np.uint64(24)).astype(np.int64)
        if j == 0:
            place, first = k, k
        else:
            if permutation is None:
                permutation = np.tile(np.arange(length, dtype=np.uint16), (len(elements), 1))
                rows = np.arange(len(elements))
                permutation[rows, first] = 0
                permutation[:, 0] = first
            rows = np.arange(len(elements))
            place = permutation[rows, k].astype(np.int64)
            permutation[rows, k] = permutation[:, j]
            permutation[:, j] = place
        np.minimum.at(signature, text * length + place, value)
        open_ = signature.reshape(n, length).max(axis=1) >= np.uint64((j + 1) << 40)
        if not open_.any():
            break
        active = open_[text]
        if not active.all():
            elements, text = elements[active], text[active]
            if j == 0:
                first = first[active]
            else:
                permutation = permutation[active]
    return signature.reshape(n, length)


def _prints(sets: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """128 bits for each set, 0 for an empty one."""
    prints = np.zeros((len(limits) - 1, 2), np.int64)
    for i in np.flatnonzero(np.diff(limits)).tolist():
        digest = hashlib.blake2b(sets[limits[i] : limits[i + 1]].tobytes(), digest_size=16).digest()
        prints[i] = np.frombuffer(digest, np.int64)
    return prints


def _signing(size: int, length: int, bands: int):
    rows = length // bands

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for first, last in chunks(offsets):
                sets, limits = shingle_sets(data, offsets, first, last, size)
                counts = np.diff(limits)
                full = np.flatnonzero(counts)
                signature = superminhash(sets, np.concatenate([[0], np.cumsum(counts[full])]), length)
                prints = _prints(sets, limits)
                keys = np.zeros((last - first, bands), np.uint64)
                folded = np.arange(1, bands + 1, dtype=np.uint64)[None, :] * np.uint64(0xE7037ED1A0B428DB)
                for r in range(rows):
                    folded = mix(folded * np.uint64(0x9FB21C651E98DF25) + signature[:, r::rows][:, :bands])
                keys[full] = folded
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(first, last - first),
                        "n_shingles": pa.array(counts.astype(np.int64)),
                        "print_a": pa.array(prints[:, 0]),
                        "print_b": pa.array(prints[:, 1]),
                        "bands": pa.ListArray.from_arrays(
                            pa.array(np.arange(last - first + 1, dtype=np.int32) * bands),
                            pa.array(keys.view(np.int64).ravel()),
                        ),
                    }
                )

    return sign


def _setting(size: int):
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch["text"])
            for first, last in chunks(offsets):
                sets, limits = shingle_sets(data, offsets, first, last, size)
                prints = _prints(sets, limits)
                yield pa.record_batch(
                    {
                        "print_a": pa.array(prints[:, 0]),
                        "print_b": pa.array(prints[:, 1]),
                        "items": pa.ListArray.from_arrays(
                            pa.array(limits.astype(np.int32)), pa.array(sets.view(np.int64))
                        ),
                    }
                )

    return sets_of


def near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    percent: int = 80,
    length: int = 96,
    bands: int = 24,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents whose distinct word shingles have a Jaccard similarity of at least
    `percent` / 100 are linked; component_id is the smallest doc_id reachable,
    and that document is kept. Documents with equal sets form a class and are
    represented by one of them. Two classes are compared if a band of their
    signatures agrees, which at a similarity of 0.8 fails for 3 pairs in a
    million with the defaults; every link is confirmed on the full sets. Each
    bucket first compares its members with its smallest one only. Buckets whose
    members are then still in different components compare the members outside
    the largest component with all others, block by block inside the tasks,
    which return no more links than components; so large groups of copies emit
    no pairs, and no link is lost.

    Shingles are compared by 64-bit hashes and sets by 128-bit ones. Null and
    word-free texts have no shingles and are linked with nothing. Rows without
    id are kept, with null component. Equal ids count as one document with
    several texts: what is near any of them is linked with it. Very long texts
    are taken whole, an empty table gives no rows, and other columns are not
    looked at.
    """
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = materialize(
        given.mapInArrow(
            _signing(shingle, length, bands),
            "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>",
        ),
        "near-signatures",
    )
    # A number of its own for each class, as documents of one id may be in several.
    classes = materialize(
        signed.filter("n_shingles > 0 and doc_id is not null")
        .groupBy(*_SET)
        .agg(F.min("doc_id").alias("rep"), F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"))
        .withColumn("class", F.monotonically_increasing_id()),
        "near-classes",
    )
    placed = materialize(signed.join(classes.select(*_SET, "class", "rep"), _SET, "left").drop("bands", *_SET), "near-rows")
    links = _links(given, classes, shingle, percent).union(_same_id(placed))
    found = components(materialize(links, "near-links"))
    named = found.join(classes.select(F.col("class").alias("node"), "rep"), "node")
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "rep", "doc_id")).alias("component_id")
    return (
        placed.join(found.join(smallest, "component"), F.col("class") == F.col("node"), "left")
        .select("doc_id", "n_shingles", component)
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _same_id(placed: DataFrame) -> DataFrame:
    """Links between the classes of documents that share an id."""
    several = (
        placed.filter(F.col("class").isNotNull())
        .groupBy(F.col("doc_id").alias("of"))
        .agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .filter("low < high")
    )
    several = materialize(several, "near-several")
    return placed.join(several, F.col("doc_id") == F.col("of")).filter("class <> low").select(F.col("class").alias("u"), F.col("low").alias("v"))


def _enough(common: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return common * 100 >= (n_a + n_b - common) * percent


def _links(given: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    rows = classes.select(F.col("class").alias("rep"), "n", F.explode("bands").alias("key"))
    shared = (
        rows.groupBy("key")
        .agg(F.count(F.lit(1)).alias("members"), F.min("rep").alias("hub"))
        .filter("members > 1")
    )
    buckets = materialize(rows.join(shared.select("key", "hub"), "key"), "near-buckets")
    touched = materialize(
        buckets.select(F.col("rep").alias("class")).distinct().join(classes.select("class", "rep", *_SET), "class"),
        "near-touched",
    )
    # Stored by themselves, so that their measured size decides whether the texts are shuffled.
    reps = materialize(touched.select(F.col("rep").alias("doc_id")).distinct(), "near-reps")
    of_rep = given.join(reps, "doc_id", "left_semi")
    sets = materialize(
        # One shuffle of the sets: the join finds them by the columns it needs.
        of_rep.mapInArrow(_setting(shingle), "print_a long, print_b long, items array<long>")
        .dropDuplicates(_SET)
        .join(touched.select(F.col("class").alias("rep"), *_SET), _SET)
        .select("rep", "items"),
        "near-sets",
    )
    pairs = buckets.filter("rep <> hub").select("rep", "hub").distinct()
    of_hub = sets.select(F.col("rep").alias("hub"), F.col("items").alias("hub_items"))
    stars = materialize(
        pairs.join(sets, "rep")
        .join(of_hub, "hub")
        .filter(
            _enough(
                F.size(F.array_intersect("items", "hub_items")), F.size("items"), F.size("hub_items"), percent
            )
        )
        .select(F.col("rep").alias("u"), F.col("hub").alias("v")),
        "near-stars",
    )
    return stars.union(_leftover_links(buckets, components(stars), sets, percent))


def _leftover_links(buckets: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between bucket members that the bucket's hub left unconnected."""
    placed = materialize(
        buckets.filter("rep <> hub")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select("key", "rep", F.coalesce("component", "rep").alias("component")),
        "near-placed",
    )
    per_key = (
        placed.groupBy("key", "component")
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("key")
        .agg(
            F.sum("rows").alias("members"),
            F.max(F.struct("rows", "component")).alias("largest"),
            F.count(F.lit(1)).alias("parts"),
        )
        .filter("parts > 1")
        .select(
            "key",
            F.col("largest.component").alias("largest"),
            F.ceil(F.col("members") / _BLOCK).cast("int").alias("all_blocks"),
            F.ceil((F.col("members") - F.col("largest.rows")) / _BLOCK).cast("int").alias("own_blocks"),
        )
    )
    open_ = materialize(placed.join(per_key, "key"), "near-open")
    spread = F.abs(F.xxhash64("rep", "key") % F.lit(2**31))

    def dealt(own: bool) -> DataFrame:
        mine, other = ("own_blocks", "all_blocks") if own else ("all_blocks", "own_blocks")
        rows = open_.filter(F.col("component") != F.col("largest")) if own else open_
        block = (spread % F.col(mine)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        at = rows.select("key", "rep", "component", block.alias("mine"), every.alias("other"))
        i, j = ("mine", "other") if own else ("other", "mine")
        return at.select("key", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(own).alias("own"), "rep", "component")

    group = ["key", "i", "j"]
    members = dealt(True).union(dealt(False)).join(sets, "rep")
    return (
        members.repartition(*group)
        .sortWithinPartitions(*group)
        .select(*group, "own", "rep", "component", "items")
        .mapInArrow(_block_links(percent), "u long, v long")
    )


def _block_links(percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            part = pa.Table.from_batches([batch])
            if not len(part):
                continue
            ids = [part[c].to_numpy() for c in ("key", "i", "j")]
            new = np.zeros(len(part), bool)
            for x in ids:
                new[1:] |= x[1:] != x[:-1]
            if held:
                new[0] = any(held[-1][c][-1].as_py() != x[0] for c, x in zip(("key", "i", "j"), ids))
            cuts = [0, *np.flatnonzero(new).tolist(), len(part)]
            for a, b in zip(cuts, cuts[1:]):
                if a in cuts[1:-1] and held:
                    yield from _block(pa.concat_tables(held), percent)
                    held = []
                if b > a:
                    held.append(part.slice(a, b - a))
        if held:
            yield from _block(pa.concat_tables(held), percent)

    return linked


def _block(group: pa.Table, percent: int) -> Iterator[pa.RecordBatch]:
    group = group.combine_chunks()
    own = group["own"].to_numpy(zero_copy_only=False)
    rep, component = group["rep"].to_numpy(), group["component"].to_numpy()
    items = group["items"].combine_chunks()
    limits = items.offsets.to_numpy()
    values = items.values.to_numpy()
    size = np.diff(limits)
    left, right = np.flatnonzero(own), np.flatnonzero(~own)
    if not len(left) or not len(right):
        return
    row = np.repeat(np.arange(len(group)), size)
    flat = values[limits[0] : limits[-1]]
    vocabulary, code = np.unique(flat, return_inverse=True)
    met = np.zeros((2, len(vocabulary)), bool)
    met[own[row].astype(int), code] = True
    shared = np.cumsum(met.all(axis=0)) - 1  # place of a shingle among those on both sides
    use = met.all(axis=0)[code]
    code, row = shared[code[use]], row[use]
    order = np.argsort(code, kind="stable")
    code, row = code[order], row[order]
    place = np.empty(len(group), np.int64)
    place[left], place[right] = np.arange(len(left)), np.arange(len(right))
    common = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, int(code[-1]) + 1 if len(code) else 0, _COLUMNS):
        a, b = np.searchsorted(code, [start, start + _COLUMNS])
        width = min(_COLUMNS, int(code[-1]) + 1 - start)
        sides = [np.zeros((len(left), width), np.float32), np.zeros((len(right), width), np.float32)]
        for side, mine in zip(sides, (own[row[a:b]], ~own[row[a:b]])):
            side[place[row[a:b][mine]], code[a:b][mine] - start] = 1
        common += sides[0] @ sides[1].T
    union = size[left][:, None] + size[right][None, :] - common
    fits = (common * 100 >= union * percent) & (component[left][:, None] != component[right][None, :])
    x, y = np.nonzero(fits)
    if not len(x):
        return
    a, b = component[left[x]], component[right[y]]
    _, once = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1, return_index=True)
    node, low = union_find(a[once], b[once])
    yield pa.record_batch({"u": node[node != low], "v": low[node != low]})
