"""Near-duplicates by SimHash, found by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits both lie within r bits of one in the middle. So every
fingerprint emits all its variants within half the radius, one shuffle brings equal variants
together, and whatever meets is verified. With r = 1 a 64-bit fingerprint has 65 variants, and a
variant can be met by 65 different fingerprints at most: copies are collapsed before, so buckets are
bounded by construction, whatever the size of a group of copies.

A fingerprint may be longer than the word it is searched by, and the radius larger. It is then cut into so
many words that within the radius one of them differs in at most two bits: 39 of 256 bits take 14 words of
18 or 19. Each word has its own ball, and every pair that meets is verified on all 256 bits. That finds
less similar texts than one 64-bit word can.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.llm.components import connected_components
from spanweave.llm.textbatch import free_name, slices, text_buffer, words
from spanweave.operators.lineage import materialize

#: Fixed value: seed of the shingles' XXH64.
SEED = 42
#: Bytes of text fingerprinted at once.
BATCH_BYTES = 1 << 19
#: Odd constant that sets the lanes of a long fingerprint apart (2^64 over the golden ratio).
LANE_STEP = 0x9E3779B97F4A7C15
#: Fingerprints in a group of the search by several words, on average; pairs verified at once.
MEMBERS, CHUNK = 8192, 1 << 16


def shingle_hashes(raw: bytes, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all word shingles, A-Z lowered, end to end, and n + 1 offsets into them."""
    found, at = words(raw, offsets, lower=True)
    bounds = np.frombuffer(found.buffers()[1], np.int64)
    lengths, n_words = np.diff(bounds), np.diff(at)
    order = np.arange(len(lengths))
    spaced = np.full(int(bounds[-1]) + len(order), 32, np.uint8)  # a space after each word
    if len(order):
        flat = np.frombuffer(found.buffers()[2], np.uint8)
        spaced[np.arange(len(flat)) + np.repeat(order, lengths)] = flat
    starts = bounds[:-1] + order
    ends = starts + lengths
    n_shingles = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
    out = np.concatenate([[0], np.cumsum(n_shingles)])
    first = np.arange(out[-1]) - np.repeat(out[:-1] - at[:-1], n_shingles)
    last = first + np.repeat(np.minimum(size, n_words) - 1, n_shingles)
    text, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    pairs = zip(starts[first].tolist(), ends[last].tolist())
    return np.fromiter((digest(text[a:b], SEED) for a, b in pairs), np.uint64, len(first)), out


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Independent 64 bits of the same hashes, by the finalizer of SplitMix64; lane 0 is the hash."""
    if lane == 0:
        return hashes
    x = hashes + np.uint64(lane * LANE_STEP % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def simhash(hashes: np.ndarray, offsets: np.ndarray, lanes: int) -> np.ndarray:
    """n x lanes fingerprints: a bit is 1 if set in over half of a document's hashes."""
    out = np.zeros((len(offsets) - 1, lanes), np.uint64)
    edges = offsets.tolist()
    for lane in range(lanes):
        octets = _mixed(hashes, lane).astype("<u8").view(np.uint8).reshape(-1, 8)
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            if a == b:
                continue
            ones = np.zeros(64, np.int64)
            for c in range(a, b, 1 << 16):  # long texts in pieces
                ones += np.unpackbits(octets[c : min(b, c + (1 << 16))], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            out[i, lane] = np.packbits(ones * 2 > b - a, bitorder="little").view("<u8")[0]
    return out


def fingerprints(df: DataFrame, text: str = "text", size: int = 3, lanes: int = 1, name: str = "fingerprint") -> DataFrame:
    """Add an array of ``lanes`` 64-bit fingerprints of every whole text's ``size``-word shingles.

    A text of fewer words is one shingle; one without a word, or null, has fingerprint zero.
    """
    kept = [f for f in df.schema.fields if f.name != name]
    names = [f.name for f in kept]
    schema = df.select(*names, F.array(F.lit(0).cast("long")).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, BATCH_BYTES):
                hashes, at = shingle_hashes(*text_buffer(part.column(text)), size)
                got = simhash(hashes, at, lanes).view(np.int64)
                bounds = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * lanes)
                column = pa.ListArray.from_arrays(bounds, pa.array(got.ravel()))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), column], [*names, name])

    return df.select(*names).mapInArrow(run, schema)


def _words(prints: np.ndarray, n_words: int) -> list[tuple[np.ndarray, int]]:
    """The bits of n x lanes fingerprints cut into words of about equal length: values and bits of each."""
    bits = np.unpackbits(np.ascontiguousarray(prints, "<u8").view(np.uint8), axis=1, bitorder="little")
    edges = np.linspace(0, bits.shape[1], n_words + 1).astype(int)
    return [(bits[:, a:b].astype(np.uint64) @ (np.uint64(1) << np.arange(b - a, dtype=np.uint64)), int(b - a)) for a, b in zip(edges[:-1], edges[1:])]


def spanning_links(prints: np.ndarray, low: np.ndarray, own: np.ndarray, low_bits: int, side: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Positions of verified links that connect what all verified links between these rows connect.

    Rows meet in the variants of ``low``; a row that is not ``own`` came by a flipped bit and has one. All
    pairs that meet are verified, but for those connected already and, if there are two sides, those of one side.
    """
    n = len(prints)
    flipped = np.flatnonzero(own)
    who = np.concatenate([np.arange(n)] + [flipped] * low_bits)
    keys = np.concatenate([low] + [low[flipped] ^ (np.uint64(1) << np.uint64(b)) for b in range(low_bits)])
    order = np.argsort(keys, kind="stable")
    keys, who = keys[order], who[order]
    parent, links = list(range(n)), []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    def verify(a: np.ndarray, b: np.ndarray) -> bool:
        close = np.bitwise_count(prints[a] ^ prints[b]).sum(axis=1, dtype=np.int64) <= radius
        before = len(links)
        for i, j in zip(a[close].tolist(), b[close].tolist()):
            x, y = root(i), root(j)
            if x != y:
                parent[x] = y
                links.append((i, j))
        return len(links) > before

    def bounds() -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return starts, np.diff(np.append(starts, len(keys)))

    # First each bucket's first against the others: that connects most buckets of near copies.
    starts, lengths = bounds()
    head = np.repeat(who[starts], lengths)
    for i in range(0, len(who), CHUNK):
        a, b = head[i : i + CHUNK], who[i : i + CHUNK]
        verify(a[a != b], b[a != b])
    # Then all pairs of the buckets that are not connected as a whole.
    two_sides, shift = bool((side != side[0]).any()), 0
    fresh = False
    at = None
    while len(keys):
        if not fresh:
            label = np.array([root(i) for i in range(n)])
            starts, lengths = bounds()
            mixed_up = np.minimum.reduceat(label[who], starts) != np.maximum.reduceat(label[who], starts)
            left = np.repeat(mixed_up & (lengths > shift + 1), lengths)
            keys, who, fresh, found = keys[left], who[left], True, False
            if not len(keys):
                break
            starts, lengths = bounds()
            end, at = np.repeat(starts + lengths, lengths), np.arange(len(keys))
        shift += 1
        at = at[at + shift < end[at]]
        if not len(at):
            break
        for i in range(0, len(at), CHUNK):
            a, b = who[at[i : i + CHUNK]], who[at[i : i + CHUNK] + shift]
            ask = label[a] != label[b]
            if two_sides:
                ask &= side[a] != side[b]
            found |= verify(a[ask], b[ask])
        fresh = not (found and shift % 16 == 0)
    return links


def similar_pairs(classes: DataFrame, lanes: int = 1, word_bits: int = 64, radius: int = 2) -> DataFrame:
    """Verified links ``src, dst`` between different fingerprints ``fp`` (array) with ids ``id``.

    With one 64-bit word and radius 2 the links connect exactly the fingerprints that differ in at
    most two bits: all that meet in a bucket link to its smallest id, from which none is further
    than 2 bits. Else fingerprints are cut into words of at most ``word_bits``, and so many that two
    fingerprints within ``radius`` differ in at most two bits of one and meet there. All pairs that meet are
    verified on whole fingerprints, and of the links those are given that connect the same fingerprints as
    all do; so they connect exactly the fingerprints within ``radius``.
    """
    if lanes > 1 or word_bits < 64 or radius > 2:
        return _links_by_words(classes, lanes, word_bits, radius)
    flips = F.array(*[F.lit(0).cast("long")] + [F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    # Dealt out before they are grouped: nearly all variants are alone, so that grouping on both sides of
    # the shuffle would cost memory and save nothing.
    buckets = (
        classes.select("id", F.col("fp")[0].alias("word"))
        .select("id", F.explode(F.transform(flips, lambda f: F.col("word").bitwiseXOR(f))).alias("variant"))
        .repartition("variant")
        .groupBy("variant")
        .agg(F.sort_array(F.collect_list("id")).alias("met"))  # at most 65
        .where(F.size("met") > 1)
    )
    # Each to the first and to the one before it.
    chained = F.flatten(
        F.transform(
            F.slice("met", 2, 65),
            lambda m, i: F.array(
                F.struct(F.col("met")[0].alias("src"), m.alias("dst")), F.struct(F.get("met", i).alias("src"), m.alias("dst"))
            ),
        )
    )
    pairs = buckets.select(F.inline(chained)).distinct()
    first = classes.select(F.col("id").alias("src"), F.col("fp")[0].alias("x"))
    second = classes.select(F.col("id").alias("dst"), F.col("fp")[0].alias("y"))
    distance = F.bit_count(F.col("x").bitwiseXOR(F.col("y")))
    return pairs.join(first, "src").join(second, "dst").where(distance <= radius).select("src", "dst")


def _links_by_words(classes: DataFrame, lanes: int, word_bits: int, radius: int) -> DataFrame:
    """A group has the fingerprints with the same top bits of a word, and those that get them by one
    flipped bit; the variants of the bits below are made inside the group. So a fingerprint moves once
    per top bit and not once per variant. A large group is dealt into pieces and each pair of pieces is a group."""
    # Of so many words one differs in at most two bits, whatever pair is within the radius.
    n_words = max(-(-64 * lanes // word_bits), radius // 3 + 1)
    if n_words > 64 * lanes:
        raise ValueError(f"{radius} bits are too many for fingerprints of {64 * lanes}")
    n = classes.count()
    top = 0
    while top < 64 * lanes // n_words and n * (1 + top) > MEMBERS << top:
        top += 1
    names = [f"f{i}" for i in range(lanes)]

    def groups(prints: np.ndarray) -> Iterator[np.ndarray]:
        for w, (word, bits) in enumerate(_words(prints, n_words)):
            own = (word >> np.uint64(bits - top)).astype(np.int64) if top else np.zeros(len(word), np.int64)
            for flip in [0, *(1 << b for b in range(top))]:
                yield (own ^ flip) | (w << 40)

    def prints_of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("fp").flatten().to_numpy().reshape(-1, lanes).view(np.uint64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = prints_of(batch)
            columns = [pa.array(prints[:, i].view(np.int64)) for i in range(lanes)] if len(prints) else []
            for group in groups(prints) if len(prints) else ():
                yield pa.RecordBatch.from_arrays([pa.array(group), batch.column("id"), *columns], ["group", "id", *names])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                group, members = np.unique(np.concatenate(list(groups(prints_of(batch)))), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(members)], ["group", "n"])

    table = classes.select(F.col("id").cast("long").alias("id"), "fp")
    placed = table.mapInArrow(place, f"group long, id long, {', '.join(f'{c} long' for c in names)}")
    sizes = table.mapInArrow(count, "group long, n long").groupBy("group").agg(F.sum("n").alias("n"))
    # Pieces grow with the root of the group, so that copies do too.
    length = F.greatest(F.lit(2 * MEMBERS), F.ceil(4 * F.sqrt("n")))
    large = materialize(sizes.where(F.col("n") > 2 * MEMBERS).select("group", F.ceil(F.col("n") / length).alias("pieces")), "simhash-large")
    dealt = placed.join(large, "group", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64(F.lit("piece"), "id"), "pieces"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        prints = np.stack([group[c].to_numpy() for c in names], axis=1).view(np.uint64)
        key, ids = int(group["group"].iloc[0]), group["id"].to_numpy()
        word, bits = _words(prints, n_words)[key >> 40]
        low_bits = bits - top
        own = (word >> np.uint64(low_bits)) == np.uint64(key & (1 << 40) - 1) if top else np.ones(len(word), bool)
        low = word & np.uint64((1 << low_bits) - 1)
        at = np.array(spanning_links(prints, low, own, low_bits, group["own"].to_numpy(), radius), np.int64).reshape(-1, 2)
        return pd.DataFrame({"src": ids[at].min(axis=1), "dst": ids[at].max(axis=1)})

    pairs = dealt.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("pieces", "other")
    return pairs.groupBy("group", "lo", "hi").applyInPandas(compare, "src long, dst long").distinct()


def near_duplicates(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 3,
    lanes: int = 1,
    word_bits: int = 64,
    radius: int = 2,
    keep_text: bool = False,
) -> DataFrame:
    """``df``'s rows (without the text, unless asked) with ``fingerprint`` (array), ``component_id``
    and ``kept``.

    ``component_id`` is the smallest id reachable over links, the row's own included (null ids are
    passed over; it is null if there is no other). ``kept`` marks one row of each component: one with
    that id. Texts of equal fingerprints are linked; null and empty texts are, by fingerprint zero.
    Columns of ``df`` with these names are replaced. An empty table stays empty.
    """
    df = df.drop("fingerprint", "component_id", "kept")
    row = free_name(df, "_row")
    marked = fingerprints(df, text, size, lanes).withColumn(row, F.monotonically_increasing_id())
    marked = materialize(marked if keep_text else marked.drop(text), "simhash")
    member = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc"), F.col(row).alias("row"))
    classes = materialize(
        marked.groupBy("fingerprint").agg(F.min(member).alias("first"))
        .select(F.col("fingerprint").alias("fp"), F.col("first.row").alias("id"), "first"),
        "simhash-classes",
    )
    links = similar_pairs(classes.select("id", "fp"), lanes, word_bits, radius)
    grouped = connected_components(links)
    labelled = classes.join(grouped, classes["id"] == grouped["node"], "left").select(
        "fp", "first", F.coalesce("component", "id").alias("group")
    )
    # As plain tables, so that skewed joins can split the other side.
    heads = materialize(labelled.groupBy("group").agg(F.min("first").alias("head")), "simhash-groups")
    by_print = materialize(labelled.select("fp", "group").join(heads, "group").select("fp", "head"), "simhash-heads")
    return (
        marked.join(by_print, marked["fingerprint"] == by_print["fp"])
        .select(
            *[marked[c] for c in marked.columns if c != row],
            by_print["head"]["doc"].alias("component_id"),
            (marked[row] == by_print["head"]["row"]).alias("kept"),
        )
    )
