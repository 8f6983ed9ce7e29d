"""Phrase collocation mining: Toivonen's sample, negative border, exact full pass, closure.

A sample of the documents, mined level by level with a lowered least count, proposes phrases. One full pass
then counts every word, every proposed phrase and the proposal's negative border: the phrases
that were not proposed although both parts one word shorter were. A border phrase that turns out frequent is
a failure of the sample; a further pass counts every phrase of frequent words that such a failure lies in. That
closes the count, for any sample: of a frequent phrase that the first pass didn't count, the shortest part
that is frequent and not proposed has all its own parts proposed, so it is a failure of the border.

Most of the border is rare, so these passes count 62-bit keys of phrases, with 23 bits of a second hash whose
smallest and largest value tell keys that stand for two phrases. What is left is given its text: by passes over a 64th
and an eighth of the documents and one over all, each of which looks only for phrases that no pass before it has
found, so that a phrase is named a few times however often it occurs. If two phrases share a
key, a pass over all documents counts everything left by its text instead. Whether a phrase is known is asked of a filter
of bounded size, which can only know too many. Counts are combined per block of text (8 MB) before their
shuffle, so a phrase that every document holds is one row per block.

Defined results: a null text has no words; a null ``lang`` is ``und``; repeated rows count each time;
a row's id and its other columns don't matter; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webevents.llm.common import batch_of, global_rank, stored

LONGEST = 4  # words in a phrase
SHARE = 8  # one document of so many is in the sample
LOWERED = 0.8  # of the count to be expected in the sample
BLOCK_BYTES = 1 << 23  # text whose words are numbered and counted at a time
FILTER_BITS = 1 << 26  # at most; 8 MB
BITS_EACH = 32

# What separates pieces, and words within a piece.
BREAKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" "
)
_BREAK = "\n"
_SPACE = pa.scalar(" ", pa.large_string())
KEYED = "key long, n long"
CHECK_BITS = 23  # of a key's second hash, above its count in a block
COUNT_BITS = 63 - CHECK_BITS
NAMING = (64, 8)  # of so many documents one is searched for the texts of keys, before all are
CALLED = "lang string, k int, phrase string, key long, n long"
NAMED = "lang string, k int, phrase string, n long"
_KEYED = pa.schema([("key", pa.int64()), ("n", pa.int64())])
_NAMED = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.large_string()), ("n", pa.int64())])


def _word_hashes(words: list, lang: str, other: int = 0) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode(), other)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _longer(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all words but the last and that of the last."""
    return prefix * np.uint64(0x9E3779B97F4A7C15) + word


def _keys(hashes: np.ndarray, k: int) -> np.ndarray:
    """62 bits of the hash, and the number of words less one."""
    h = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) & ~np.uint64(3) | np.uint64(k - 1)


def _checked(n: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Counts with bits of the phrases' second hashes above them."""
    bits = (other ^ (other >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - CHECK_BITS)
    return n.astype(np.int64) | (bits << np.uint64(COUNT_BITS)).view(np.int64)


def _grouped(keys: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and their counts, checked."""
    order = np.argsort(keys)
    keys = keys[order]
    begins = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[begins], _checked(np.diff(begins, append=len(keys)), other[order[begins]])


def words_in(key: Column) -> Column:
    """Number of words of a key's phrase."""
    return key.bitwiseAND(F.lit(3)) + 1


class Held:
    """A set of keys as a filter: never denies one it holds."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @staticmethod
    def places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(bits - 1)
        return keys >> np.uint64(2) & mask, (keys * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(29)) & mask

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self.places(keys, 64 * len(self.slots)):
            out &= (self.slots[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return out


def held(keys: DataFrame) -> Held:
    """The filter of ``keys`` (key): set bits meet in Spark, at most ``FILTER_BITS`` reach the driver."""
    entries = keys.count()
    bits = 1 << 10
    while bits < min(entries * BITS_EACH, FILTER_BITS):
        bits *= 2

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = batch.column(0).to_numpy().view(np.uint64)
                at = np.unique(np.concatenate(Held.places(own, bits)))
                slot, first = np.unique(at >> np.uint64(6), return_index=True)
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield batch_of(pa.schema([("slot", pa.int64()), ("bits", pa.int64())]), slot.astype(np.int64), value.view(np.int64))

    found = keys.select("key").mapInArrow(set_bits, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
    slots = np.zeros(bits // 64, np.uint64)
    slots[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Held(slots)


def _by_lang(langs: pa.Array, values: pa.Array) -> Iterator[tuple[str, pa.Array]]:
    for lang in pc.unique(langs):
        yield lang.as_py(), values.filter(pc.equal(langs, lang))


def _numbered(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """Number of each word in order, and the words; a break between pieces is a word of its own."""
    joined = b"\n".join(texts).translate(_TABLE).replace(b"\n", b" \n ")
    offsets = pa.array([0, len(joined)], pa.int64()).buffers()[1]
    whole = pa.LargeStringArray.from_buffers(1, offsets, pa.py_buffer(joined))
    words = pc.list_flatten(pc.split_pattern(whole, " "))
    coded = words.filter(pc.not_equal(words, "")).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.large_string())


def _key_counts(
    texts: list[bytes], lang: str, levels: range, known: Callable, fresh: Callable | None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and checked counts of one language's texts, level by level, as ``count_keys`` has it."""
    codes, words = _numbered(texts)
    if not len(codes):
        return
    real = pc.not_equal(words, _BREAK).to_numpy(zero_copy_only=False)
    listed = words.to_pylist()
    word_hash, word_other = _word_hashes(listed, lang), _word_hashes(listed, lang, 1)
    keys = _keys(word_hash, 1)
    if 1 in levels:
        yield keys[real], _checked(np.bincount(codes, minlength=len(words)), word_other)[real]
    # for every place: the hash of the phrase that begins there, and whether it may be part of a longer one
    hashes, last_word = word_hash[codes], word_hash[codes]
    others, last_other = word_other[codes], word_other[codes]
    part = known_word = (real & known(keys))[codes]
    holds_fresh = None if fresh is None else (real & fresh(keys))[codes]
    for k in range(2, levels[-1] + 1):
        hashes, others = _longer(hashes[:-1], last_word[k - 1 :]), _longer(others[:-1], last_other[k - 1 :])
        at = np.flatnonzero(part[:-1] & (part[1:] if fresh is None else known_word[k - 1 :]))
        keys = _keys(hashes[at], k)
        told = np.ones(len(at), bool)
        if fresh is not None:
            told = holds_fresh[:-1][at] | holds_fresh[1:][at] | fresh(keys)
            holds_fresh = np.zeros(len(hashes), bool)
            holds_fresh[at[told]] = True
        if k in levels:
            yield _grouped(keys[told], others[at[told]])
        part = np.zeros(len(hashes), bool)
        part[at if fresh is not None else at[known(keys)]] = True


def _named_counts(
    texts: list[bytes], lang: str, chosen: Held, wanted: Held | None = None
) -> Iterator[tuple[int, pa.Array, np.ndarray, np.ndarray]]:
    """(k, phrases, keys, counts) of the phrases of one language's texts that ``chosen`` (and ``wanted``) holds, after
    k = 0 and all words. ``chosen`` holds the parts of what it holds."""
    codes, words = _numbered(texts)
    if not len(codes):
        return
    real = pc.not_equal(words, _BREAK).to_numpy(zero_copy_only=False)
    n = np.bincount(codes, minlength=len(words))
    yield 0, pa.array([""], pa.large_string()), np.zeros(1, np.uint64), np.array([n[real].sum()])
    word_hash = _word_hashes(words.to_pylist(), lang)
    # phrases of k words: hash, last word, and that of all words but the last; the places where one begins, and which
    hashes, last, before = word_hash, np.arange(len(words)), []
    at, which, n_places = np.arange(len(codes)), codes, len(codes)
    keys = _keys(word_hash, 1)
    stays, first = np.flatnonzero(real & chosen(keys)), None
    for k in range(1, LONGEST + 1):
        new = np.full(len(hashes), -1)
        new[stays] = np.arange(len(stays))
        keys, hashes, last, n = keys[stays], hashes[stays], last[stays], n[stays]
        before.append((None if first is None else first[stays], last))
        told = np.arange(len(stays)) if wanted is None else np.flatnonzero(wanted(keys))
        phrase_words, row = [], told
        for prefix, own in reversed(before):
            phrase_words.append(words.take(pa.array(own[row])))
            row = row if prefix is None else prefix[row]
        yield k, pc.binary_join_element_wise(*reversed(phrase_words), _SPACE), keys[told], n[told]
        if k == LONGEST or not len(stays):
            return
        number = np.full(n_places, -1)  # at every place
        number[at] = new[which]
        at = np.flatnonzero((number[:-1] >= 0) & (number[1:] >= 0))
        pairs, which, n = np.unique(number[at] * len(stays) + number[at + 1], return_inverse=True, return_counts=True)
        n_places -= 1
        first, rest = np.divmod(pairs, len(stays))
        last, hashes = last[rest], _longer(hashes[first], word_hash[last[rest]])
        keys = _keys(hashes, k + 1)
        stays = np.flatnonzero(chosen(keys))


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[str, list[bytes]]]:
    """Language and texts, about ``most`` bytes of texts at a time and one text at least."""
    block, size = {}, 0
    for batch in batches:
        for lang, texts in _by_lang(batch.column(0), batch.column(1)):
            for text in texts.cast(pa.large_binary()):
                text = text.as_py()
                block.setdefault(lang, []).append(text)
                size += len(text)
                if size >= most:
                    yield from block.items()
                    block, size = {}, 0
    yield from block.items()


def _all(keys: np.ndarray) -> np.ndarray:
    return np.ones(len(keys), bool)


def count_keys(texts: DataFrame, levels: range, known: Held | None = None, fresh: Held | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n, low, high): how often the phrases of ``levels`` words occur in ``texts`` (lang, text), never less than
    that, and the smallest and largest check of the key's phrases.

    Counted are all words, and longer phrases both of whose parts one word shorter ``known`` holds (None: all).
    With ``fresh``, instead the phrases of known words that ``fresh`` holds or that contain one which it holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, block_bytes):
            for keys, n in _key_counts(block, lang, levels, known or _all, fresh):
                yield batch_of(_KEYED, keys.view(np.int64), n)

    # a block's counts hardly meet again in their task, so they go to their key's task as they are: a
    # frequent phrase is a row per block there
    n, check = F.col("n").bitwiseAND(F.lit((1 << COUNT_BITS) - 1)), F.shiftright("n", COUNT_BITS)
    return texts.mapInArrow(count, KEYED).repartition("key").groupBy("key").agg(
        F.sum(n).alias("n"), F.min(check).alias("low"), F.max(check).alias("high")
    )


def count_named(texts: DataFrame, chosen: Held, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, k, phrase, n): how often each phrase that ``chosen`` holds occurs, exactly, and as k = 0 the number of
    all words of a language. ``chosen`` holds the parts of what it holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, block_bytes):
            for k, phrases, _, n in _named_counts(block, lang, chosen):
                yield batch_of(_NAMED, pa.repeat(lang, len(n)), np.full(len(n), k), phrases, n)

    return texts.mapInArrow(count, NAMED).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def call_keys(texts: DataFrame, chosen: Held, wanted: Held, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, k, phrase, key, n): the phrases that both hold, as often as blocks hold them, and as k = 0 a
    block's number of words."""
    schema = pa.schema([*_NAMED][:3] + [pa.field("key", pa.int64()), pa.field("n", pa.int64())])

    def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, block in _blocks(batches, block_bytes):
            for k, phrases, keys, n in _named_counts(block, lang, chosen, wanted):
                yield batch_of(schema, pa.repeat(lang, len(n)), np.full(len(n), k), phrases, keys.view(np.int64), n)

    return texts.mapInArrow(call, CALLED)


def called(chosen: DataFrame, parts: list[DataFrame], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, k, phrase, n) of ``chosen`` (key, n), none of whose keys stands for two phrases, and as k = 0 the number of
    all words of a language. Texts are looked for in one of ``parts`` (lang, text) after the other; the last holds all."""
    of_chosen, missing, found = held(chosen), chosen, None
    for i, texts in enumerate(parts):
        calls = call_keys(texts, of_chosen, held(missing), block_bytes).groupBy("lang", "k", "phrase", "key").agg(F.sum("n").alias("words"))
        if i < len(parts) - 1:
            calls = calls.where("k > 0")
        calls = stored(calls, "phrases-called")
        found = calls if found is None else found.unionByName(calls)
        if i < len(parts) - 1:
            missing = stored(missing.join(calls.select("key"), "key", "left_anti"), "phrases-missing")
    names = found.where("k > 0").select("lang", "k", "phrase", "key").distinct()
    return names.join(chosen.select("key", "n"), "key").select("lang", "k", "phrase", "n").unionByName(
        calls.where("k = 0").select("lang", "k", "phrase", F.col("words").alias("n"))
    )


def mine_sample(sample: DataFrame, least: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n) of phrases that occur ``least`` times in ``sample``: words and pairs, then level by level."""
    proposed, known = None, None
    for levels in (range(1, 3), *(range(k, k + 1) for k in range(3, LONGEST + 1))):
        found = stored(count_keys(sample, levels, known, block_bytes=block_bytes).where(F.col("n") >= least), "phrases-sample")
        proposed = found if proposed is None else proposed.unionByName(found)
        if found.isEmpty():
            break
        known = held(proposed)
    return proposed


def frequent_phrases(
    docs: DataFrame, *, least: int = 30, lang: str = "lang", text: str = "text", share: int = SHARE, lowered: float = LOWERED,
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, n) of every phrase of 1 to ``LONGEST`` words that occurs ``least`` times, and (lang, n) of all words.

    ``share`` and ``lowered`` set the sample (1: all documents) and its least count, and with them the
    number of passes, never the result."""
    rows = docs.select(F.col(f"`{lang}`").alias("_lang"), F.col(f"`{text}`").alias("_text"), F.xxhash64(*[
        F.col(f"`{f.name}`") for f in docs.schema if f.dataType.simpleString() in ("bigint", "int", "string")
    ]).alias("_hash"))
    rows = rows.where(F.col("_text").isNotNull())
    texts = rows.select(F.coalesce("_lang", F.lit("und")).alias("lang"), F.col("_text").alias("text"))

    def one_of(share: int) -> DataFrame:
        part = rows.where(F.pmod("_hash", F.lit(share)) == 0)
        return part.select(F.coalesce("_lang", F.lit("und")).alias("lang"), F.col("_text").alias("text"))

    sample = one_of(share)
    proposed = mine_sample(sample, max(2, round(lowered * least / share)), block_bytes)

    counted = count_keys(texts, range(1, LONGEST + 1), held(proposed), block_bytes=block_bytes)
    chosen = stored(counted.where(F.col("n") >= least), "phrases-keys")
    # failures of the border: frequent, but not proposed; what has LONGEST words is part of nothing
    fresh = chosen.join(proposed.select("key"), "key", "left_anti").where(words_in(F.col("key")) < LONGEST)
    fresh = stored(fresh.select("key"), "phrases-fresh")
    if not fresh.isEmpty():
        more = count_keys(texts, range(2, LONGEST + 1), held(chosen), held(fresh), block_bytes)
        both = chosen.unionByName(more.where(F.col("n") >= least)).groupBy("key")
        chosen = stored(both.agg(F.max("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")), "phrases-keys")
    if chosen.where("low <> high").isEmpty():
        named = called(chosen, [*(one_of(n) for n in NAMING), texts], block_bytes)
    else:
        named = count_named(texts, held(chosen), block_bytes).where((F.col("k") == 0) | (F.col("n") >= least))
    named = stored(named, "phrases-frequent")
    return named.where("k > 0"), named.where("k = 0").select("lang", "n")


def _words(phrase: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), start, length), " ")


def collocations(docs: DataFrame, *, least: int = 30, top: int | None = 2000, cover: int = 80, **columns) -> DataFrame:
    """(lang, rank, phrase, k, a, l, r, n, score): phrases of two words or more by the score of their weakest cut.

    A cut after the first words scores floor(2,000,000 a / (l + r)), for the counts a of the phrase, l and
    r of its parts; of equally low cuts the first counts. Phrases whose words lie inside a longer one with at
    least ``cover`` percent of their count are dropped. ``top`` (None: all) is how many a language reports.
    """
    frequent, totals = frequent_phrases(docs, least=least, **columns)
    phrases = frequent.where("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"))
    part = frequent.select("lang", "phrase", "n")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "*", _words(F.col("phrase"), F.lit(1), F.col("cut")).alias("first"),
        _words(F.col("phrase"), F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    for name, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part.select("lang", F.col("phrase").alias(name), F.col("n").alias(count)), ["lang", name])
    score = F.expr(
        "cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)"
    )
    weakest = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct(score.alias("score"), "cut", "l", "r", "a", "k")).alias("weakest")
    )
    inside = (
        phrases.where("k >= 3")
        .select("lang", "a", "phrase", "k", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("length"))
        .select("lang", "a", "phrase", "length", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("length") + 1)).alias("start"))
        .groupBy("lang", _words(F.col("phrase"), F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("longer"))
    )
    kept = (
        weakest.join(inside, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | F.expr(f"cast(100 as decimal(3,0)) * cast(longer as decimal(20,0)) < cast({cover} as decimal(3,0)) * cast(weakest.a as decimal(20,0))"))
        .select("lang", "phrase", "weakest.*")
    )
    order = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    placed = stored(global_rank(kept, order, "place", "phrases-ranked"), "phrases-placed")
    starts = placed.groupBy("lang").agg(F.min("place").alias("start")).join(totals, "lang")
    # a row per language, stored so that its size decides how it is joined
    ranked = placed.join(stored(starts, "phrases-starts"), "lang").withColumn("rank", F.col("place") - F.col("start") + 1)
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "k", "a", "l", "r", "n", "score")


def op13_toivonen_phrases(docs: DataFrame) -> DataFrame:
    """Each language's first 2,000 collocations."""
    return collocations(docs.select("doc_id", "lang", "text")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_aggregate(list_slice(w, i, i + k - 1), 'string_agg', ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) AS ks(k) WHERE len(w) >= k
), counted AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counted WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k >= 2 AND f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, cut, x.f AS l, y.f AS r, (2000000 * c.a::HUGEINT) // (x.f::HUGEINT + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), weakest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, sub, max(a) AS longer
  FROM (SELECT lang, a, array_to_string(w[start:start + size - 1], ' ') AS sub
        FROM (SELECT *, unnest(range(1, k - size + 2)) AS start
              FROM (SELECT *, unnest(range(2, k)) AS size FROM cand WHERE k >= 3)))
  GROUP BY lang, sub
), kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.sub = w.phrase
  WHERE i.longer IS NULL OR 100 * i.longer::HUGEINT < 80 * w.a::HUGEINT
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
       n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""
