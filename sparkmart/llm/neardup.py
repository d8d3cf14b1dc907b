"""Near-duplicate documents by one-permutation MinHash.

A document is its set of hashed 5-word shingles. The hashes fall into BINS bins by their top bits
and the smallest of each bin is kept: one hash function serves all bins. An empty bin borrows from
a bin chosen by its own sequence of hashed draws, the first that isn't empty (optimal
densification), the same draws for every document. ROWS bins make a band; documents with an equal
band meet in a bucket.

Documents with equal sets are one node, however many. In a bucket, candidates are star-shaped: its
centre against all others, so a bucket of n nodes gives n - 1 pairs. The first centre is the node
that meets most others over all its buckets, the one in the middle of its group. Pairs are
confirmed on the full sets. Linked nodes are joined into components. Large buckets that still hold
more than one component get a few rounds more, with new centres drawn per bucket against one member
of each component. What the stars leave is settled exactly: nodes of buckets with more than one
component meet by a prefix filter. Two sets that are similar enough have one of their rarest
shingles in common: among the first n - ceil(6 n / 7) + 1 of the smaller set and the first
n - ceil(3 n / 4) + 1 of the larger one, both in one order by frequency. No bucket, group, round or
candidate list is capped.

So every link between documents that share a bucket is found, or its ends are joined by others. Two
documents at similarity 0.75 share no bucket with a chance below 1 in 100,000.

Defined results: null texts and texts without words have an empty set and are linked with nothing.
Rows of one doc_id are one document: what links one links all. Rows without doc_id get no
component and are kept. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import spans
from .components import components
from .work import Work

SHINGLE, BINS, ROWS = 5, 128, 4
BANDS = BINS // ROWS
#: Rounds of stars at most. More of them leave less to the prefix filter; links don't depend on it.
ROUNDS = 4
#: Buckets of so many nodes get no more than the first star before the prefix filter.
SMALL_BUCKET = 64
#: Shingles are counted in 2**SLOT_BITS slots to order them by frequency.
SLOT_BITS = 20

PREFIX = "id long, size long, place long, opens boolean, key long"

SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The different shingle hashes of all texts in ascending order, and their n + 1 offsets."""
    words, offsets = spans.word_hashes(column, spans.NOT_SPACE)
    counts = np.diff(offsets)
    docs, keys = [], []
    for n in range(1, SHINGLE + 1):
        of = np.flatnonzero(counts == n if n < SHINGLE else counts >= n)
        if len(of):
            starts = spans.ragged(offsets[of], counts[of] - n + 1)
            docs.append(np.repeat(of, counts[of] - n + 1))
            keys.append(spans.gram_hashes(words, n)[starts])
    if not docs:
        return np.zeros(0, np.uint64), np.zeros(len(counts) + 1, np.int64)
    doc, key = np.concatenate(docs), np.concatenate(keys)
    order = np.lexsort((key, doc))
    doc, key = doc[order], key[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    doc, key = doc[new], key[new]
    return key, np.searchsorted(doc, np.arange(len(counts) + 1))


def _draws() -> np.ndarray:
    """For each bin the bins that it tries in turn when it is empty."""
    return np.random.default_rng(17).integers(0, BINS, (8 * BINS, BINS))


def signatures(keys: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The densified minima, a row for each text that has shingles."""
    full = np.flatnonzero(np.diff(offsets))
    doc = np.repeat(np.arange(len(full)), np.diff(offsets)[full])
    bins = (keys >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    cell = doc * BINS + bins
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # hashes ascend, so the first of a bin is its smallest
    minima = np.zeros(len(full) * BINS, np.uint64)
    filled = np.zeros(len(full) * BINS, bool)
    minima[cell[first]], filled[cell[first]] = keys[first], True
    empty = np.flatnonzero(~filled)
    out = minima.copy()
    for draw in _draws():
        if not len(empty):
            break
        source = empty // BINS * BINS + draw[empty % BINS]
        ok = filled[source]
        out[empty[ok]] = minima[source[ok]]
        empty = empty[~ok]
    for cell in empty.tolist():  # every draw missed: the next bin that isn't empty
        row = cell // BINS * BINS
        later = (cell + 1 + np.flatnonzero(np.roll(filled[row : row + BINS], -(cell - row) - 1))[0] - row) % BINS
        out[cell] = minima[row + later]
    return out.reshape(len(full), BINS)


def band_keys(minima: np.ndarray) -> np.ndarray:
    out = np.zeros((len(minima), BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        out = spans.mix(out + minima[:, r::ROWS][:, :BANDS] * np.uint64(0x9E3779B97F4A7C15))
    return out


def set_hashes(keys: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent sums over each set: equal for equal sets, together 128 bits."""
    sums = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        total = np.concatenate([[np.uint64(0)], np.cumsum(spans.mix(keys ^ np.uint64(salt)), dtype=np.uint64)])
        sums.append(total[offsets[1:]] - total[offsets[:-1]])
    return sums[0], sums[1]


def _signature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in spans.sliced(batches):
        keys, offsets = shingle_sets(batch.column("text"))
        counts = np.diff(offsets)
        a, b = set_hashes(keys, offsets)
        bands = band_keys(signatures(keys, offsets)).view(np.int64).reshape(-1)
        cuts = np.concatenate([[0], np.cumsum(np.where(counts > 0, BANDS, 0))])
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(bands))
        columns = [batch.column("doc_id"), pa.array(counts), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), lists]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_a", "set_b", "bands"])


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node and its sorted shingles, for the rows whose text has the node's set."""
    for batch in spans.sliced(batches):
        keys, offsets = shingle_sets(batch.column("text"))
        a, b = set_hashes(keys, offsets)
        want = [batch.column(c).to_numpy().view(np.uint64) for c in ("set_a", "set_b")]
        rows = np.flatnonzero((a == want[0]) & (b == want[1]))
        raw, cuts = keys.tobytes(), (8 * offsets).tolist()
        found = pa.array([raw[cuts[i] : cuts[i + 1]] for i in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(rows)), found], ["node", "shingles"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sets have 100 * intersection >= 75 * union."""
    for batch in batches:
        kept = []
        for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            if 100 * min(len(x), len(y)) < 75 * max(len(x), len(y)):
                continue
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= 75 * (len(both) - common):
                kept.append(i)
        rows = pa.array(kept, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("a").take(rows), batch.column("b").take(rows)], ["a", "b"])


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough. The set of b joins first: a is the centre and may
    be in very many pairs, which adaptive execution splits against the centre's one row."""
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(y, "b").join(x, "a").select("a", "b", "x", "y").mapInArrow(_linked, "a long, b long")


def _slots(keys: np.ndarray) -> np.ndarray:
    return (spans.mix(keys) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of the sets lie in each slot."""
    total = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in spans.sliced(batches, "shingles"):
        total += np.bincount(_slots(spans.text_bytes(batch.column("shingles"))[0].view(np.uint64)), minlength=len(total))
    some = np.flatnonzero(total)
    for at in range(0, len(some), 1 << 16):
        part = some[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["slot", "n"])


def prefixes(keys: np.ndarray, offsets: np.ndarray, frequency: np.ndarray) -> tuple[np.ndarray, ...]:
    """The rarest shingles of each set by slot and key: set, size of it, place in the order, whether
    the smaller set of a pair can open with it, and shingle."""
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((keys, frequency[_slots(keys)], doc))
    size, place = sizes[doc], np.arange(len(keys)) - offsets[doc]
    first = place <= size - (3 * size + 3) // 4
    opens = place <= size - (6 * size + 6) // 7
    return doc[first], size[first], place[first], opens[first], keys[order][first]


def rare_pairs(work: Work, sets: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs (a, b), not all of them similar, of nodes in different parts: all that are similar are
    among them. parts: id, part. A set's shingles are ordered by how frequent they are in these sets,
    so what a whole source has in common comes last and opens no pair."""
    sets = work.stored(sets.join(parts, sets["node"] == parts["id"]).select("id", "shingles"), "open")
    frequency = np.zeros(1 << SLOT_BITS, np.int64)
    slots = sets.select("shingles").mapInArrow(_slot_rows, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    frequency[slots["slot"].to_numpy()] = slots["n"].to_numpy()
    shared = work.spark.sparkContext.broadcast(frequency)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in spans.sliced(batches, "shingles"):
            raw, offsets = spans.text_bytes(batch.column("shingles"))
            doc, *columns, key = prefixes(raw.view(np.uint64), offsets // 8, shared.value)
            columns = [batch.column("id").take(pa.array(doc)), *(pa.array(x) for x in columns), pa.array(key.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "size", "place", "opens", "key"])

    mates = parts.join(parts.groupBy("part").agg(F.count("*").alias("mates")), "part")
    rows = work.stored(sets.mapInArrow(run, PREFIX).join(mates, "id"), "prefixes")
    # members of a shingle's largest part needn't meet each other
    keys = rows.groupBy("key").agg(
        F.min("part").alias("low"), F.max("part").alias("high"), F.max("opens").alias("opened"), F.max(F.struct("mates", "part")).alias("top")
    )
    keys = keys.where("opened and low <> high").select("key", F.col("top.part").alias("top"))
    met = work.stored(rows.join(keys, "key").select("key", "id", "size", "place", "opens", "part", (F.col("part") == F.col("top")).alias("main")), "rare")
    one = met.where("opens").select("key", F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("place").alias("place_a"), F.col("part").alias("part_a"), F.col("main").alias("main_a"))
    two = met.withColumnRenamed("id", "b")
    pairs = one.where("not main_a").join(two, "key").unionByName(one.where("main_a").join(two.where("not main"), "key"))
    # a is the smaller set; what two sets have in common lies behind their first common shingle
    pairs = pairs.where("part_a <> part and (size_a < size or size_a = size and a < b) and 4 * size_a >= 3 * size")
    pairs = pairs.where("7 * least(size_a - place_a, size - place) >= 3 * (size_a + size)")
    return pairs.select("a", "b").distinct()


def find_groups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    work = Work(spark)
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    rows = work.stored(texts.mapInArrow(_signature_rows, SIGNATURE), "signatures")
    full = rows.where("doc_id is not null and n_shingles > 0")
    nodes = full.groupBy("set_a", "set_b").agg(F.min(F.struct("doc_id", "bands")).alias("first"))
    nodes = nodes.select("set_a", "set_b", F.col("first.doc_id").alias("node"), "first.bands", F.monotonically_increasing_id().alias("id"))
    nodes = work.stored(nodes, "nodes")

    # a doc_id may have rows with different texts; its sets are linked, and a node is a set
    named = full.select("doc_id", "set_a", "set_b").distinct()
    shared = named.groupBy("doc_id").agg(F.count("*").alias("sets")).where("sets > 1").select("doc_id")
    ids = nodes.select("set_a", "set_b", "id", "node")
    same = named.join(shared, "doc_id").join(ids, ["set_a", "set_b"])
    same = same.join(same.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").select("a", F.col("id").alias("b"))

    bands = nodes.select("id", F.explode("bands").alias("key"))
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    met = work.stored(bands.join(sizes, "key"), "buckets")
    weights = met.groupBy("id").agg(F.sum("size").alias("weight"))
    met = work.stored(met.join(weights, "id").select("key", "id", "size", "weight"), "weighted")

    wanted = ids.join(weights.select("id"), "id", "left_semi")
    wanted = wanted.select(F.col("node").alias("doc_id"), F.col("id").alias("node"), "set_a", "set_b")
    sets = work.stored(texts.join(wanted, "doc_id").select("node", "text", "set_a", "set_b").mapInArrow(_set_rows, "node long, shingles binary"), "sets")
    if sets.count() > sets.select("node").distinct().count():  # repeated rows
        sets = work.stored(sets.dropDuplicates(["node"]), "sets")

    found = work.spark.createDataFrame([], "node long, component long")
    links = work.stored(same.where("a <> b").distinct(), "links")
    if links.limit(1).count():
        found = components(work, links)

    def in_parts(rows: DataFrame) -> DataFrame:
        rows = rows.join(found, rows["id"] == found["node"], "left")
        return rows.select("key", "id", "size", "weight", F.coalesce("component", "id").alias("part"))

    def mixed(rows: DataFrame) -> DataFrame:
        """The buckets that hold more than one component."""
        parts = rows.groupBy("key").agg(F.min("part").alias("low"), F.max("part").alias("high"))
        return rows.join(parts.where("low <> high").select("key"), "key")

    def joined(pairs: DataFrame) -> bool:
        """Confirm pairs and join the components of those that are links."""
        nonlocal found, links
        new = work.stored(confirm(pairs, sets), "links")
        if not new.limit(1).count():
            return False
        links = links.union(new)
        found = components(work, links)
        return True

    for turn in range(ROUNDS):
        rows_of = in_parts(met if turn == 0 else met.where(F.col("size") > SMALL_BUCKET))
        order = F.col("weight") if turn == 0 else F.xxhash64("id", "key", F.lit(turn))
        one = F.max(F.struct(order.alias("order"), F.col("id").alias("a"), F.col("part").alias("part_a"))).alias("c")
        if turn:  # one member speaks for what is joined already
            rows_of = rows_of.groupBy("key", "part").agg(F.max(F.struct(order.alias("order"), "id"))["id"].alias("id"))
            one = F.max(F.struct(F.xxhash64("id", F.lit(turn)).alias("order"), F.col("id").alias("a"), F.col("part").alias("part_a"))).alias("c")
        centres = rows_of.groupBy("key").agg(one, F.min("part").alias("low"), F.max("part").alias("high"))
        centres = centres.where("low <> high").select("key", "c.a", "c.part_a")
        pairs = rows_of.join(centres, "key").where("part <> part_a").select("a", F.col("id").alias("b"))
        pairs = pairs.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct() if turn else pairs.distinct()
        if not joined(pairs) and turn:
            break

    left = work.stored(mixed(in_parts(met)).select("id", "part").distinct(), "left")
    if left.limit(1).count():
        joined(rare_pairs(work, sets, left))

    # the label of a component is an id of a set; its smallest doc_id is the smallest node's
    named = ids.join(found.withColumnRenamed("node", "id"), "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("node").alias("component_id"))
    named = named.join(least, "component").select("set_a", "set_b", "component_id")
    out = rows.drop("bands").join(named, ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def keep_one(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose document is the first of its group."""
    groups = find_groups(spark, docs)
    dropped = groups.where(~F.col("kept")).select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")
