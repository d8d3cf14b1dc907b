"""Spelling variants: words one letter apart, joined to the far more frequent form.

Words are counted in SQL. Two words one letter apart have a beginning or an end in common: with s
the length of the shorter one, the first s // 2 letters or the last s - s // 2. So a word goes into
the buckets of its beginning and its end, for s its own length and one less, and meets there every
word that it can be near. Words of the end buckets are turned round, so that all buckets share a
beginning.

A bucket is searched by a bit-sliced position index: for each position and letter a bitset over the
bucket's words, a whole number in Python. One pass over the letters of a word keeps, for all words
of the bucket at once, those without an error so far and those with one: a replaced letter (same
position), a letter more (next position) or a letter less (position before). The bits follow falling
counts, so the lowest bit of a result is its most frequent word; a pass gives a count and a best
word, and no pair is ever written. Buckets of more than TILE words are dealt into tiles of index
words against tiles of asking words, so no task holds a whole bucket; every tile is searched.

A form has at least RATIO times the count of its word, so forms lead to forms in few steps. The
last one is found by one join a step.

Defined results: null and empty texts have no words. A null doc_id is written as nothing before the
colon. Repeated rows count again. Runs of any length are words. Ties in count go to the smaller word
in code-point order. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .work import Work

#: Letters of words, shortest word, fewest occurrences, one run in how many loses a
#: letter, how much more frequent a form is.
LETTERS, SHORTEST, LEAST, DAMAGED, RATIO = "[A-Za-zÀ-ÿ]", 7, 2, 31, 10
#: Words of an index, and words that ask it, at most.
TILE = 1 << 13

ROWS = ("backward", "s", "shared", "tile", "asks", "word", "n")
NEAR = "word string, n long, n_near long, near_n long, near string"


def count_words(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """word and n, its occurrences in all texts; only words of `least` occurrences and more."""
    found = F.regexp_extract_all(docs["text"], F.lit(f"{LETTERS}{{{SHORTEST},}}"), F.lit(0))
    runs = docs.select(docs["doc_id"].cast("string").alias("id"), F.explode(found).alias("run"))
    upper, lower = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
    runs = runs.select("id", F.translate("run", upper, lower).alias("run"))
    runs = runs.select("run", F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("run"))).alias("sum"))
    place = (F.col("sum") % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, F.char_length("run")))
    words = runs.select(F.when(F.col("sum") % DAMAGED == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= least)


class PositionIndex:
    """Words that share their first `start` letters, in falling order of count."""

    def __init__(self, words: list[str], start: int):
        self.start, self.everything = start, (1 << len(words)) - 1
        self.at: dict[int, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self.of_length: dict[int, int] = defaultdict(int)
        for i, word in enumerate(words):
            bit = 1 << i
            self.of_length[len(word)] |= bit
            for place in range(start, len(word)):
                self.at[place][word[place]] |= bit

    def _with(self, place: int, letter: str) -> int:
        return self.at[place].get(letter, 0) if place in self.at else 0  # the lookup alone would add the place

    def replaced_or_longer(self, word: str) -> int:
        """The words with one letter replaced or one more than `word` has."""
        none, replaced, more = self.everything, 0, 0
        for place in range(self.start, len(word)):
            here = self._with(place, word[place])
            more = (more | none) & self._with(place + 1, word[place])
            kept = none & here
            replaced = replaced & here | none ^ kept
            none = kept
            if not (none or replaced or more):
                return 0
        n = len(word)
        return replaced & self.of_length.get(n, 0) | (more | none) & self.of_length.get(n + 1, 0)

    def shorter(self, word: str) -> int:
        """The words with one letter less than `word` has."""
        none, less = self.everything, 0
        for place in range(self.start, len(word)):
            less = less & self._with(place - 1, word[place]) | none
            none &= self._with(place, word[place])
            if not (none or less):
                return 0
        return less & self.of_length.get(len(word) - 1, 0)


def search(backward: bool, s: int, index: list[tuple[int, str]], asking: list[tuple[int, str]]) -> Iterator[tuple]:
    """(word, n, number of near words, count and name of the best) of the asking words that have any.

    index, asking: (n, word) of one bucket. Pairs whose shorter word has s letters are meant; the end
    buckets leave out those that share their beginning too, which the other bucket has.
    """
    index = sorted(index, key=lambda x: (-x[0], x[1]))
    if not any(len(w) == s for _, w in index) and not any(len(w) == s for _, w in asking):
        return
    turn = (lambda w: w[::-1]) if backward else (lambda w: w)
    bits = PositionIndex([turn(w) for _, w in index], s - s // 2 if backward else s // 2)
    begins: dict[str, int] = defaultdict(int)
    if backward:
        for i, (_, w) in enumerate(index):
            begins[w[: s // 2]] |= 1 << i
    for n, word in asking:
        hits = bits.replaced_or_longer(turn(word)) if len(word) == s else bits.shorter(turn(word))
        if hits and backward:
            hits &= ~begins.get(word[: s // 2], 0)
        if hits:
            best_n, best = index[(hits & -hits).bit_length() - 1]
            yield word, n, hits.bit_count(), best_n, best


def _search_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and tile; one tile is held at a time."""
    names = [x.split()[0] for x in NEAR.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ROWS))

    out: list[tuple] = []
    for (backward, s, _, _), group in groupby(rows(), itemgetter(0, 1, 2, 3)):
        index: list[tuple[int, str]] = []
        asking: list[tuple[int, str]] = []
        for *_, asks, word, n in group:
            if asks is not True:  # false: an index word; null: the bucket has one tile, so both
                index.append((n, word))
            if asks is not False:
                asking.append((n, word))
        if len(index) > 1 or index != asking:
            out += search(backward, s, index, asking)
        if len(out) >= 20_000:
            yield packed(out)
            out = []
    if out:
        yield packed(out)


def near_words(work: Work, words: DataFrame, tile: int = TILE) -> DataFrame:
    """For every bucket that a word has near words in: word, n, their number, the best one's n and name."""
    length = F.char_length("word")

    def bucket(backward: bool, less: int):
        s = length - less
        head = (s / 2).cast("int")
        shared = F.right("word", s - head) if backward else F.left("word", head)
        return F.struct(F.lit(backward).alias("backward"), s.alias("s"), shared.alias("shared"))

    kinds = F.array(*[bucket(b, less) for b in (False, True) for less in (0, 1)])
    keyed = words.select("word", "n", F.explode(kinds).alias("b")).select("b.*", "word", "n")
    key = ["backward", "s", "shared"]
    counts = keyed.groupBy(*key).agg(F.count("*").alias("size"))
    large = work.stored(counts.where(F.col("size") > tile), "large")
    keyed = keyed.join(large, key, "left")
    parts = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("word"), parts).cast("int")
    every = F.sequence(F.lit(0), parts - 1)
    # a word of a large bucket is in the index of one row of tiles and asks in one column of them
    dealt = F.concat(
        F.transform(every, lambda other: F.struct((own * parts + other).alias("tile"), F.lit(False).alias("asks"))),
        F.transform(every, lambda other: F.struct((other * parts + own).alias("tile"), F.lit(True).alias("asks"))),
    )
    single = F.array(F.struct(F.lit(0).alias("tile"), F.lit(None).cast("boolean").alias("asks")))
    tiles = keyed.withColumn("_t", F.explode(F.when(F.col("size").isNull(), single).otherwise(dealt)))
    tiles = tiles.select(*key, "_t.tile", "_t.asks", "word", "n").repartition(*key, "tile")
    return tiles.sortWithinPartitions(*key, "tile").select(*ROWS).mapInArrow(_search_rows, NEAR)


def follow(work: Work, forms: DataFrame) -> DataFrame:
    """word and root, the last form that can be reached, of words whose form has a form. Every step
    multiplies the count by RATIO, so there are fewer rounds than digits in the largest count."""
    step = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    at, rounds = forms.withColumnRenamed("form", "root"), []
    while not rounds or rounds[-1].limit(1).count():
        at = work.stored(at.join(step, "root").select("word", F.col("next").alias("root")), "steps")
        rounds.append(at)
    last = F.max(F.struct("turn", "root"))["root"].alias("root")
    steps = [rows.withColumn("turn", F.lit(turn)) for turn, rows in enumerate(rounds)]
    return reduce(DataFrame.unionByName, steps).groupBy("word").agg(last)


def group_variants(spark: SparkSession, docs: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word."""
    work = Work(spark)
    words = work.stored(count_words(docs), "words")
    alone = words.selectExpr("word", "n", "0L AS n_near", "cast(null AS long) AS near_n", "cast(null AS string) AS near")
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("rank"), "near", "near_n")))
    found = near_words(work, words, tile).unionByName(alone).groupBy("word", "n")
    found = found.agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    strong = F.col("best.near_n") >= RATIO * F.col("n")
    found = found.select("word", "n", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, F.col("best.near_n")).alias("form_n"))
    found = work.stored(found, "forms")
    roots = follow(work, found.where(F.col("form").isNotNull()).select("word", "form"))
    root = F.coalesce("root", "form", "word").alias("root")
    return found.join(roots, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
