"""Phrase collocations by stripes: each word keys a counter of what follows it.

One pass over the texts counts the words, in a stripe of the empty prefix (with the number of all words, under null). Then a pass for each phrase length k counts the phrases of
k words as 64-bit hashes, and a last one hands on stripes: a word with the one to four words that follow it in phrases whose hash reached `least`, and how often. A task counts a chunk of
texts with exact word numbers; the stripes of its chunks are joined before they are handed on, as long as they fit in HELD bytes. Stripes are then merged element by
element with partial sums before the shuffle, so that no stripe has to fit in a task. The merged stripes hold the extensions
(their elements), the totals of the parts of a phrase (each is an element itself), and the subsumption maxima (the largest element that a phrase begins or ends).

A phrase of k words can only reach `least` where both its phrases of k - 1 words do. Tasks test this with a bitmap of FILTER_BITS bits, made
in Spark from the words or hashes that reached it and of the same size whatever the corpus; a false hit costs time and changes nothing. Most phrases whose parts are frequent are rare
themselves, so that only hashes travel of them. A hash shared by two phrases lets both through, and their own counts decide.

Defined cases: a null text is empty; a null lang counts as `und`; equal rows count each; a word of bytes beyond ASCII is whole between separators; a score is
exact (38 digits); an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from framewright.llm.common import materialize, table
from framewright.llm.words import Words, byte_kinds, chunks, mixed, name_hashes, split_words

LEAST, LONGEST, TOP = 100, 5, 2000
SHARE = 100
FILTER_BITS = 1 << 26
CHUNK = 6 << 20
HELD = 32 << 20
STRIPE = 4096
KINDS = byte_kinds(b"\x20\x09", b".,;:!?\n\x0b\x0c\r")
SCORE = "1000BD * (cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
STRIPES = "lang string, prefix string, nexts array<string>, counts array<long>"


def _bits(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two places of each hash in a bitmap of so many bits, a power of two."""
    return [(hashes >> np.uint64(shift)) & np.uint64(bits - 1) for shift in (0, 32)]


def _stripes(k: int, bitmap, longest: int, reach: int | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Stripes of prefixes of k - 1 words and what follows them in phrases of k .. reach words (k alone if unset); bitmap: broadcast, of the phrases that may be frequent (none at k = 1); longest: of a stripe's part."""

    def counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words = split_words(batch.column("text"), KINDS)
        return _counted(words, batch.column("lang").dictionary_encode(), k, reach or k, None if bitmap is None else bitmap.value, longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for found in chain.from_iterable(map(counted, chunks(batches, "text", CHUNK))):
            if found.nbytes > HELD:
                yield from _sliced(found)
                continue
            held, size = [*held, found], size + found.nbytes
            if size > HELD:
                held = [_joined(held, longest)]
                size = held[0].nbytes
                if size > HELD // 2:  # joining does not make them few: the shuffle does the rest
                    yield from _sliced(held[0])
                    held, size = [], 0
        if held:
            yield from _sliced(_joined(held, longest))

    return run


def _sliced(stripes: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, stripes.num_rows, 10_000):
        yield stripes.slice(start, 10_000)


def _joined(stripes: list[pa.RecordBatch], longest: int) -> pa.RecordBatch:
    """The stripes of several chunks merged element by element, so that a prefix has one stripe (a long one: its parts)."""
    if len(stripes) == 1:
        return stripes[0]
    held = pa.Table.from_batches(stripes).combine_chunks().to_batches()[0]
    (langs, lang), (prefixes, prefix), (names, following) = (_numbered(x) for x in (held.column("lang"), held.column("prefix"), held.column("nexts").flatten()))
    heads, owner = np.unique(lang * len(prefixes) + prefix, return_inverse=True)
    owner = np.repeat(owner, held.column("nexts").value_lengths().to_numpy(zero_copy_only=False))
    keys = owner * len(names) + following
    order = np.argsort(keys, kind="stable")
    keys, count = keys[order], held.column("counts").flatten().to_numpy()[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys, count = keys[first], np.add.reduceat(count, first)
    return _laid_out(langs.take(pa.array(heads // len(prefixes))), prefixes.take(pa.array(heads % len(prefixes))), keys // len(names), names.take(pa.array(keys % len(names))), count, longest)


def _numbered(names: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct names, null among them, and each one's number."""
    coded = names.dictionary_encode(null_encoding="encode")
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _laid_out(langs: pa.Array, prefixes: pa.Array, owner: np.ndarray, nexts: pa.Array, counts: np.ndarray, longest: int) -> pa.RecordBatch:
    """Stripes of elements that ascend by owner, the place of their stripe's lang and prefix; a long stripe travels in parts."""
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    place = np.arange(len(owner)) - np.repeat(first, np.diff(np.append(first, len(owner))))
    cut = np.flatnonzero(place % longest == 0)
    offsets, heads = pa.array(np.append(cut, len(owner)).astype(np.int32)), pa.array(owner[cut])
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (nexts.cast(pa.string()), pa.array(counts.astype(np.int64)))]
    return pa.record_batch([langs.take(heads).cast(pa.string()), prefixes.take(heads).cast(pa.string()), *lists], ["lang", "prefix", "nexts", "counts"])


def _known(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have both their bits set."""
    out = np.ones(len(hashes), bool)
    live = slice(None)
    for bits in _bits(hashes, 8 * len(bitmap)):
        bits = bits[live]
        out[live] = (bitmap[bits >> np.uint64(3)] >> (bits & np.uint64(7)).astype(np.uint8)) & 1 == 1
        live = np.flatnonzero(out)
    return out


def _states(words: Words, langs: pa.DictionaryArray, lang: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Hashes of the phrases of 1, 2, .. k words at each place, as far as the texts' words go."""
    hashes = words.hashes()
    state = name_hashes([x.encode() for x in langs.dictionary.to_pylist()])[lang]
    for j in range(k):
        state = mixed(state[: len(words) - j], hashes[j:])
        yield state


def _hashed(k: int, bitmap) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Hashes and counts of the phrases of k words whose phrases of k - 1 words are both in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CHUNK):
            words, langs = split_words(batch.column("text"), KINDS), batch.column("lang").dictionary_encode()
            lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.row]
            if len(words) < k:
                continue
            *_, before, whole = _states(words, langs, lang, k)
            ok = _known(bitmap.value, before)
            found, count = np.unique(whole[ok[:-1] & ok[1:] & _together(words, k)], return_counts=True)
            cut = pa.array(np.append(np.arange(0, len(found), STRIPE), len(found)).astype(np.int32))
            out = [pa.ListArray.from_arrays(cut, pa.array(x.view(np.int64))) for x in (found, count.astype(np.int64))]
            yield pa.record_batch(out, ["hashes", "counts"])

    return run


def _together(words: Words, size: int) -> np.ndarray:
    """Where as many words of one piece stand, for each place as far as the words go."""
    return words.piece[: len(words) - size + 1] == words.piece[size - 1 :]


def _counted(words: Words, langs: pa.DictionaryArray, k: int, reach: int, bitmap: np.ndarray | None, longest: int) -> Iterator[pa.RecordBatch]:
    """The stripes of each phrase length k .. reach."""
    lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[words.row]
    reach = min(reach, len(words))
    if bitmap is None:
        phrases = {k: np.arange(len(words))} if reach >= k else {}
    else:
        phrases = {size: np.flatnonzero(_together(words, size)) for size in range(k, reach + 1)}
        phrases = {size: at[_known(bitmap, whole[at])] for size, whole in enumerate(_states(words, langs, lang, reach), 1) if (at := phrases.get(size)) is not None}
    for size, at in phrases.items():
        if len(at):
            yield _counted_at(words, langs, lang, k, size, at, longest)


def _counted_at(words: Words, langs: pa.DictionaryArray, lang: np.ndarray, k: int, size: int, at: np.ndarray, longest: int) -> pa.RecordBatch:
    """The stripes of the phrases of so many words that start at the given places."""
    used = np.zeros(len(words), bool)
    for j in range(size):
        used[at + j] = True
    places = np.flatnonzero(used)
    names, coded = words.coded(places)
    names = names.cast(pa.large_string())
    ids = np.zeros(len(words), np.int64)
    ids[places] = coded

    def numbered(code: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Some place of each distinct row of the columns, and each row's number."""
        for column in more:
            code = np.unique(code * len(names) + column, return_inverse=True)[1]
        some = np.zeros(int(code.max()) + 1, np.int64)
        some[code] = at
        return some, code

    def spelled(places: np.ndarray, begin: int, end: int) -> pa.Array:
        parts = [names.take(pa.array(ids[places + j])) for j in range(begin, end)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if len(parts) > 1 else parts[0] if parts else pa.array([""] * len(places), pa.large_string())

    heads, prefix = numbered(lang[at], *[ids[at + j] for j in range(k - 1)])
    tails, following = numbered(*[ids[at + j] for j in range(k - 1, size)])
    width = len(tails) + 1
    keys, count = np.unique(prefix * width + following, return_counts=True)
    if k == 1:  # the number of all words
        total = np.bincount(prefix)
        keys, count = np.concatenate([keys, np.arange(len(total)) * width + width - 1]), np.concatenate([count, total])
        order = np.argsort(keys, kind="stable")
        keys, count = keys[order], count[order]
    owners, owner = np.unique(keys // width, return_inverse=True)
    heads = heads[owners]
    nexts = pa.concat_arrays([spelled(tails, k - 1, size), pa.nulls(1, pa.large_string())])
    return _laid_out(langs.dictionary.take(pa.array(lang[heads])), spelled(heads, 0, k - 1), owner, nexts.take(pa.array(keys % width)), count, longest)


def _set_bits(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The places of words (lang, word) or of hashes of phrases in a bitmap of so many bits, as words of 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            if "hash" in batch.schema.names:
                state = batch.column("hash").to_numpy().view(np.uint64)
            else:
                hashes = split_words(batch.column("next"), byte_kinds(b" ")).hashes()
                state = mixed(name_hashes([x.encode() for x in batch.column("lang").to_pylist()]), hashes)
            bits = np.unique(np.concatenate(_bits(state, size)))
            yield pa.record_batch([pa.array((bits >> np.uint64(5)).astype(np.int64)), pa.array(np.uint64(1) << (bits & np.uint64(31))).cast(pa.int64())], ["word", "bits"])

    return run


def frequent_bitmap(phrases: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits of words (lang, next) or of phrases (hash): what reaches the driver has at most FILTER_BITS / 32 rows."""
    found = phrases.mapInArrow(_set_bits(FILTER_BITS), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 32, "<u4")
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype("<u4")
    return out.view(np.uint8)


def _merged(texts: DataFrame, stripes: Callable, least: int, label: str) -> DataFrame:
    """The elements (lang, prefix, next, a) of all tasks' stripes with a >= least, and of null."""
    sent = texts.mapInArrow(stripes, STRIPES)
    element = F.explode(F.arrays_zip("nexts", "counts")).alias("e")
    summed = sent.select("lang", "prefix", element).groupBy("lang", "prefix", F.col("e.nexts").alias("next")).agg(F.sum("e.counts").alias("a"))
    return materialize(summed.where((F.col("a") >= least) | F.col("next").isNull()), label)


def merged_stripes(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame | None]:
    """The words with a >= least (lang, prefix, next, a: the prefix is empty, the null element the number of all words) and such phrases of 2 .. longest words (lang, phrase, k, a), if any word has one."""
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text"))
    share = docs.sparkSession.sparkContext.broadcast
    words = _merged(texts, _stripes(1, None, STRIPE), least, "stripes-words")
    bitmap = frequent_bitmap(words.where(F.col("next").isNotNull()).select("lang", "next"))
    every = np.zeros_like(bitmap)
    for k in range(2, longest + 1):
        if not bitmap.any():
            break
        hashed = texts.mapInArrow(_hashed(k, share(bitmap)), "hashes array<long>, counts array<long>").select(F.explode(F.arrays_zip("hashes", "counts")).alias("e"))
        bitmap = frequent_bitmap(hashed.groupBy(F.col("e.hashes").alias("hash")).agg(F.sum("e.counts").alias("a")).where(F.col("a") >= least).select("hash"))
        every |= bitmap
    if not every.any():
        return words, None
    phrases = _merged(texts, _stripes(2, share(every), STRIPE, longest), least, "stripes-phrases")
    return words, phrases.select("lang", F.concat("prefix", F.lit(" "), F.col("next")).alias("phrase"), (F.size(F.split("next", " ")) + 1).alias("k"), "a")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int | None = TOP, share: int = SHARE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of 2 .. longest words; a phrase is dropped where a longer one has `share` per cent of its occurrences."""
    single, found = merged_stripes(docs, least, longest)
    total = single.where(F.col("next").isNull()).select("lang", F.col("a").alias("n"))
    if found is None:
        return total.where("false").select("lang", F.lit(1).cast("long").alias("rank"), F.col("lang").alias("phrase"), *[F.col("n").alias(c) for c in ("a", "l", "r")], "n", F.col("n").alias("score"))
    totals = single.where(F.col("next").isNotNull()).select("lang", F.col("next").alias("phrase"), "a").unionByName(found.where(F.col("k") < longest).select("lang", "phrase", "a"))
    longer = found.where(F.col("k") > 2)
    parts = [F.expr("substring_index(phrase, ' ', k - 1)"), F.expr("substr(phrase, instr(phrase, ' ') + 1)")]
    ends = reduce(DataFrame.unionByName, [longer.select("lang", part.alias("phrase"), "a") for part in parts])
    most = ends.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = found.join(most, ["lang", "phrase"], "left").where(F.col("within").isNull() | (F.lit(100) * F.col("within") < F.lit(share) * F.col("a")))
    words = F.split("phrase", " ")
    cuts = kept.select("lang", "phrase", "a", words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("left"), F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ").alias("right"))
    cuts = cuts.join(totals.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(totals.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cuts = cuts.join(materialize(total, "stripes-n"), "lang")
    scored = cuts.withColumn("score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    rows = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase"))
    ranked = rows.withColumn("rank", rank)
    ranked = ranked if top is None else ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
