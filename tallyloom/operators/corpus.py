"""Corpus-level text jobs: language and spelling."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import materialize

# A side of a join up to this many rows and bytes of text is sent to every task; see ``_small``.
BROADCAST_ROWS = 1_500_000
BROADCAST_BYTES = 100_000_000


def _small(df: DataFrame, rows: int, text_bytes: int) -> DataFrame:
    """Mark a side for broadcasting if its counted size allows it, else leave it to Catalyst."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS and text_bytes <= BROADCAST_BYTES else df


def _framed(text: Column) -> Column:
    """The words of a text in lower case, blanks between them and at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"\P{L}+", " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """All three-letter windows of the words, each word framed by blanks.

    The look-ahead walks the text once; cutting every window with substring
    would start again from the first byte each time. It begins no window in the
    middle of a letter that Java keeps as two.
    """
    return F.regexp_extract_all(_framed(text), F.lit(r"(?=(\P{Cs}[^ ].))"), F.lit(1))


# Letters whose windows are held at once.
_LETTERS = 2_000_000
# Numbers up to this one are counted in an array, others by sorting.
_DENSE = 2**22


def _windows(framed: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The windows that ``trigrams`` finds in framed texts, some millions at a time: the row and the number of
    each, and by number the three code points of the different ones. Frames keep windows inside their text."""
    framed = pc.fill_null(framed, "")
    part = np.cumsum(pc.binary_length(framed).to_numpy(zero_copy_only=False)) // _LETTERS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(framed)]
    for start, end in zip(cuts, cuts[1:]):
        some = framed.slice(start, end - start)
        ends = np.cumsum(pc.utf8_length(some).to_numpy(zero_copy_only=False).astype(np.int64))
        joined = "".join(some.to_pylist())
        for at in range(0, len(joined), _LETTERS):
            codes = np.frombuffer(joined[at : at + _LETTERS + 2].encode("utf-32-le"), dtype="<u4")
            kept = np.flatnonzero(codes[1:-1] != ord(" "))
            if not len(kept):
                continue
            rows = np.repeat(np.arange(start, end), np.diff(np.clip(ends - at, 0, len(codes)), prepend=0))[kept]
            alphabet = np.flatnonzero(np.bincount(codes))
            size = len(alphabet)
            place = np.zeros(alphabet[-1] + 1, dtype=np.int64)
            place[alphabet] = np.arange(size)
            letters = place[codes]
            key = ((letters[:-2] * size + letters[1:-1]) * size + letters[2:])[kept]
            if size**3 <= _DENSE:
                found = np.flatnonzero(np.bincount(key))
                number = np.zeros(size**3, dtype=np.int64)
                number[found] = np.arange(len(found))
                numbers = number[key]
            else:
                found, numbers = np.unique(key, return_inverse=True)
            yield rows, numbers, alphabet[np.stack([found // size**2, found // size % size, found % size], axis=1)]


def _count_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (``l``, ``gram``) in texts (``l``, ``framed``), folded some millions of windows at a time."""
    for batch in batches:
        of = pc.dictionary_encode(batch.column(0))
        language = of.indices.to_numpy(zero_copy_only=False)
        for rows, numbers, codes in _windows(batch.column(1)):
            both = language[rows].astype(np.int64) * len(codes) + numbers
            if len(of.dictionary) * len(codes) <= _DENSE:
                counts = np.bincount(both)
                pairs = np.flatnonzero(counts)
                counts = counts[pairs]
            else:
                pairs, counts = np.unique(both, return_counts=True)
            text = codes.astype("<u4").tobytes().decode("utf-32-le")
            grams = pa.array([text[k : k + 3] for k in range(0, len(text), 3)], pa.string())
            columns = [of.dictionary.take(pa.array(pairs // len(codes))), grams.take(pa.array(pairs % len(codes))), pa.array(counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["l", "gram", "n"])


def _packed(codes: np.ndarray) -> np.ndarray:
    codes = codes.astype(np.int64)
    return (codes[:, 0] << 42) | (codes[:, 1] << 21) | codes[:, 2]


def language_model(docs: DataFrame, text: str, lang: str) -> tuple[list[str], DataFrame]:
    """The languages, and each trigram with its log share in every one of them (``share_0``, ...).

    Learnt from all trigrams of the texts with a known ``lang``. Every trigram
    counts as seen once more than it was, so none is impossible.
    """
    taught = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("l"), _framed(F.col(text)).alias("framed"))
    schema = T.StructType([taught.schema["l"], T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])
    counts = materialize(taught.mapInArrow(_count_windows, schema).groupBy("l", "gram").agg(F.sum("n").alias("n")), "trigrams")
    kinds = counts.agg(F.count_distinct("gram")).first()[0]
    totals = {r["l"]: r["n"] for r in counts.groupBy("l").agg(F.sum("n").alias("n")).collect()}  # a row per language
    languages = sorted(totals)
    shares = [
        F.log((F.sum(F.when(F.col("l") == l, F.col("n")).otherwise(0)) + 1) / F.lit(float(totals[l] + kinds))).alias(f"share_{k}")
        for k, l in enumerate(languages)
    ]
    return languages, counts.groupBy("gram").agg(F.count("*").alias("in_languages"), *shares)


def _joined_sums(docs: DataFrame, doc_id: str, text: str, model: DataFrame, shares: list[str]) -> DataFrame:
    """Sums per text where the model is too large for a task."""
    grams = docs.select(doc_id, F.explode(trigrams(F.col(text))).alias("gram"))
    return grams.join(model, "gram").groupBy(doc_id).agg(*[F.sum(s).alias(s) for s in shares])


def _scored_sums(docs: DataFrame, doc_id: str, text: str, model: DataFrame, shares: list[str]) -> DataFrame:
    """Sums per text, made where the text is read by a model that every task holds."""
    table = model.select("gram", *shares).toArrow()  # bounded by its counted size
    codes = np.frombuffer("".join(table["gram"].to_pylist()).encode("utf-32-le"), dtype="<u4").reshape(-1, 3)
    order = np.argsort(_packed(codes))
    sent = docs.sparkSession.sparkContext.broadcast((_packed(codes)[order], np.stack([table[s].to_numpy()[order] for s in shares])))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = sent.value
        for batch in batches:
            sums, hits = np.zeros((len(shares), batch.num_rows)), np.zeros(batch.num_rows)
            for rows, numbers, codes in _windows(batch.column(1)):
                wanted = _packed(codes)
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                hit = known[at] == wanted
                first, count = rows[0], rows[-1] - rows[0] + 1
                hits[first : first + count] += np.bincount(rows - first, weights=hit[numbers], minlength=count)
                for k in range(len(shares)):
                    sums[k, first : first + count] += np.bincount(rows - first, weights=np.where(hit, table[k][at], 0.0)[numbers], minlength=count)
            found = pa.array(np.flatnonzero(hits))
            columns = [batch.column(0), *[pa.array(sums[k]) for k in range(len(shares))]]
            yield pa.RecordBatch.from_arrays([c.take(found) for c in columns], names=[doc_id, *shares])

    texts = docs.select(doc_id, _framed(F.col(text)).alias("framed"))
    schema = T.StructType([docs.schema[doc_id], *[T.StructField(s, T.DoubleType()) for s in shares]])
    return texts.mapInArrow(score, schema).groupBy(doc_id).agg(*[F.sum(s).alias(s) for s in shares])


def guess_language(docs: DataFrame, doc_id: str, text: str, lang: str, learn: Column | None = None) -> DataFrame:
    """Language of each text: the one in which all its trigrams together are likeliest.

    Learns from the texts with a known ``lang`` for which ``learn`` holds (all by
    default). Adds ``guess``, null for a text without a known trigram. Trigrams
    are scored where the text is read; what travels is one row of sums per text.
    """
    taught = docs if learn is None else docs.filter(learn)
    languages, model = language_model(taught, text, lang)
    if not languages:
        return docs.select(doc_id, lang).withColumn("guess", F.lit(None).cast("string"))
    model = materialize(model, "languages")
    rows = model.count()
    shares = [f"share_{k}" for k in range(len(languages))]
    small = rows * len(languages) <= BROADCAST_ROWS and rows * 8 * (2 + len(languages)) <= BROADCAST_BYTES
    sums = (_scored_sums if small else _joined_sums)(docs, doc_id, text, model, shares)
    scores = [F.struct((-F.round(f"share_{k}", 6)).alias("less"), F.lit(l).alias("guess")) for k, l in enumerate(languages)]
    best = sums.select(doc_id, F.array_min(F.array(*scores))["guess"].alias("guess"))
    return docs.select(doc_id, lang).join(best, doc_id, "left")


def _spread(df: DataFrame, key: str | Column) -> DataFrame:
    """Hash partitions in a fixed number: few rows that each mean much work are not merged into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def word_counts(texts: DataFrame, text: str) -> DataFrame:
    found = texts.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(1))).alias("word"))
    return found.groupBy("word").agg(F.count("*").alias("n"))


# Words up to this length meet in deletion keys; where one of a pair is longer, they meet in segments.
_SHORT = 32
_SEGMENTS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _hashed_deletions(letters: np.ndarray, deletions: int) -> np.ndarray:
    """Hashes of each row (a word's code points) with up to ``deletions`` of them left out.

    A polynomial in the code points, so that leaving some out takes the hashes of the parts between
    them; only the empty word's hash is 0.
    """
    rows, n = letters.shape
    power = _BASE ** np.arange(n + 1, dtype=np.uint64)
    before = np.zeros((rows, n + 1), dtype=np.uint64)
    for i in range(n):
        before[:, i + 1] = before[:, i] * _BASE + letters[:, i]

    def part(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return before[:, b] - before[:, a] * power[b - a]

    i = np.arange(n)
    ends = np.full(n, n)
    found = [before[:, n:], before[:, i] * power[n - 1 - i] + part(i + 1, ends)]
    if deletions > 1:
        i, j = np.triu_indices(n, 1)
        found.append((before[:, i] * power[j - i - 1] + part(i + 1, j)) * power[n - 1 - j] + part(j + 1, np.full(len(j), n)))
    keys = np.concatenate(found, axis=1)
    left = np.repeat([n, n - 1, n - 2][: len(found)], [f.shape[1] for f in found])
    return np.where((keys == 0) & (left > 0), np.uint64(1), keys)


def _deletion_lists(words: pa.Array, deletions: int, asked: np.ndarray | None) -> pa.Array:
    """For each word its deletion keys, or those of them in the bitmap ``asked``; none for null and for
    words longer than ``_SHORT``. A key comes twice where leaving out either of two letters gives the same."""
    length = pc.fill_null(pc.utf8_length(words), _SHORT + 1).to_numpy(zero_copy_only=False)
    owners, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for n in np.unique(length[length <= _SHORT]):
        rows = np.flatnonzero(length == n)
        joined = "".join(words.take(pa.array(rows)).to_pylist())
        letters = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4").astype(np.uint64).reshape(len(rows), n)
        keys = _hashed_deletions(letters, deletions)
        owner = np.repeat(rows, keys.shape[1])
        keys = keys.ravel()
        if asked is not None:
            bit = keys >> np.uint64(64 - (8 * len(asked)).bit_length() + 1)
            hit = np.flatnonzero((asked[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1)
            owner, keys = owner[hit], keys[hit]
        owners.append(owner)
        found.append(keys)
    owner = np.concatenate(owners)
    values = np.concatenate(found)[np.argsort(owner, kind="stable")]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def _bound(length: Column, k: int | Column) -> Column:
    return F.floor(length * k / _SEGMENTS).cast("int")


def _segment_key(length: Column, k: Column, segment: Column) -> Column:
    return F.concat_ws("|", length, k, segment)


def segment_keys(word: Column) -> Column:
    """The five segments of a word, with its length and their place. Two edits touch four of them at most."""
    n = F.length(word)
    return F.transform(
        F.sequence(F.lit(0), F.lit(_SEGMENTS - 1)),
        lambda k: _segment_key(n, k, F.substr(word, _bound(n, k) + 1, _bound(n, k + 1) - _bound(n, k))),
    )


def segment_probes(word: Column) -> Column:
    """What could be an untouched segment of a word two edits away: up to two letters longer or shorter,
    and the segment up to two places off."""
    n = F.length(word)
    near = [F.lit(d) for d in (-2, -1, 0, 1, 2)]

    def places(length: Column, k: Column) -> Column:
        width = _bound(length, k + 1) - _bound(length, k)
        starts = F.filter(
            F.transform(F.array(*near), lambda d: _bound(length, k) + d), lambda at: (at >= 0) & (at + width <= n)
        )
        return F.transform(starts, lambda at: _segment_key(length, k, F.substr(word, at + 1, width)))

    lengths = F.transform(F.array(*near), lambda d: n + d)
    segments = F.sequence(F.lit(0), F.lit(_SEGMENTS - 1))
    found = F.transform(lengths, lambda length: F.flatten(F.transform(segments, lambda k: places(length, k))))
    return F.array_distinct(F.flatten(found))


#: Bits of a bitmap of keys at most (32 MB); past that it lets more keys through, and the join does the rest.
_MOST_BITS = 2**28


def _bit(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - (bits.bit_length() - 1))


def key_bitmap(keyed: DataFrame, count: int) -> np.ndarray:
    """A bit for every value that the upper bits of ``key`` take, some sixteen bits to a key."""
    bits = min(_MOST_BITS, 2 ** max(15, (16 * count).bit_length()))
    at = _bit(F.col("key"), bits)
    pages = keyed.groupBy(F.bitmap_bucket_number(at + 1).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at + 1)).alias("bits"))
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for page in pages.collect():  # bounded by the bitmap's size
        start = (page["page"] - 1) * 4096
        bitmap[start : start + 4096] = np.frombuffer(page["bits"], dtype=np.uint8)
    return bitmap


def with_deletion_keys(
    words: DataFrame, word: str, deletions: int, long_keys: Callable[[Column], Column], asked: np.ndarray | None = None
) -> DataFrame:
    """A row per word and key. Two words few edits apart share a key, whatever their length.

    A key is the hash of the word with up to ``deletions`` letters left out: an edit costs each of two
    words one letter at most, and so does a swap of neighbours. Words of many letters would have too
    many keys; those longer than ``_SHORT``, and those that could be near one, have the keys that
    ``long_keys`` makes of their segments. Of the deletion keys only those in the bitmap ``asked``
    are handed on, if one is given.
    """
    names = words.columns
    bitmap = None if asked is None else words.sparkSession.sparkContext.broadcast(asked)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                lists = _deletion_lists(some.column(names.index(word)), deletions, None if bitmap is None else bitmap.value)
                yield pa.RecordBatch.from_arrays([*some.columns, lists], names=[*names, "keys"])

    schema = T.StructType([*words.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))])
    w = F.col(word)
    segments = F.when(F.length(w) >= _SHORT - 1, F.transform(long_keys(w), lambda k: F.xxhash64(k)))
    keyed = words.mapInArrow(add, schema)
    keys = F.when(F.length(w) < _SHORT - 1, F.col("keys")).otherwise(F.concat("keys", segments))
    return keyed.select(*names, F.explode(keys).alias("key"))


def _adjacent_swap(a: Column, b: Column) -> Column:
    """Same letters except for one pair of neighbours in reverse order."""
    differing = F.filter(
        F.sequence(F.lit(1), F.length(a)), lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))
    )
    i = F.get(differing, F.lit(0))
    neighbours = (F.size(differing) == 2) & (F.get(differing, F.lit(1)) == i + 1)
    swapped = F.substr(a, i, F.lit(2)) == F.reverse(F.substr(b, i, F.lit(2)))
    return (F.length(a) == F.length(b)) & neighbours & swapped


def _after_a_swap(a: Column, near: Callable[[Column], Column]) -> Column:
    """``near`` holds for ``a`` with some pair of neighbours in reverse order."""
    places = F.when(F.length(a) > 1, F.sequence(F.lit(1), F.length(a) - 1)).otherwise(F.array().cast("array<int>"))
    return F.exists(
        places, lambda i: near(F.concat(F.substr(a, F.lit(1), i - 1), F.reverse(F.substr(a, i, F.lit(2))), F.substr(a, i + 2)))
    )


def _shortest(known: DataFrame) -> DataFrame:
    """Words of one and two letters that may answer for the key of the empty word.

    All such words share it. Those with a common letter share another key too, and of the others
    only the first choice of either length can win.
    """
    order = F.struct((-F.col("n")).alias("less"), "candidate")
    return (
        known.filter(F.length("candidate") <= 2)
        .groupBy(F.length("candidate"))
        .agg(F.min_by(F.struct("candidate", "n"), order).alias("best"))
        .select("best.candidate", "best.n", F.lit(0).cast("long").alias("key"))
    )


def spelling_candidates(unknown: DataFrame, known: DataFrame, deletions: int) -> DataFrame:
    """Pairs (word, candidate, n) that share a deletion key; a pair may come once per shared key.

    ``unknown`` has ``word``, ``known`` has ``candidate`` and ``n``. The keys of the unknown words are
    few; a bitmap of them keeps the others from leaving the tasks that make those of the known words.
    They are sent there as a whole as long as their counted number allows it; past that both sides
    are dealt by key, and a key that many words share is split by AQE.
    """
    wrong = materialize(with_deletion_keys(unknown.select("word"), "word", deletions, segment_probes).distinct(), "asked-keys")
    rows, size = wrong.agg(F.count("*"), F.coalesce(F.max(F.octet_length("word")), F.lit(0))).first()
    spread = _spread(known.select("candidate", "n"), F.xxhash64("candidate"))
    keyed = with_deletion_keys(spread, "candidate", deletions, segment_keys, key_bitmap(wrong, rows))
    right = keyed.filter("key <> 0").unionByName(_shortest(known))
    return right.join(_small(wrong, rows, rows * min(size, 64)), "key").select("word", "candidate", "n")


def _one_edit(w: Column, c: Column) -> Column:
    return (F.levenshtein(w, c, 1) == 1) | _adjacent_swap(w, c)


def _two_edits(w: Column, c: Column) -> Column:
    """Two insertions, deletions, changes or swaps of neighbours, for words that are not one edit apart."""
    plain = F.levenshtein(w, c, 4)  # a swap of neighbours is two plain edits
    mine, other = F.split(w, ""), F.split(c, "")
    # a swap changes no letters, so what else there is changes one at most
    alike = (F.size(F.array_except(mine, other)) <= 1) & (F.size(F.array_except(other, mine)) <= 1)
    swap_and_edit = _after_a_swap(w, lambda s: F.levenshtein(s, c, 1) == 1) | _after_a_swap(c, lambda s: F.levenshtein(s, w, 1) == 1)
    two_swaps = _after_a_swap(w, lambda s: _adjacent_swap(s, c))
    same = (F.length(w) == F.length(c)) & (F.array_sort(mine) == F.array_sort(other))
    return (plain == 2) | ((plain == 3) & alike & swap_and_edit) | ((plain > 2) & same & two_swaps)


def _choice(pairs: DataFrame, near: Column) -> DataFrame:
    """Of the candidates for which ``near`` holds the most frequent one, then the first."""
    return pairs.filter(near).groupBy("word").agg(
        F.min_by("candidate", F.struct((-F.col("n")).alias("less"), "candidate")).alias("found")
    )


def correct_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The correction of each distinct ``word``: itself if known or if nothing is near.

    ``vocabulary`` has ``word`` and its frequency ``n``. Nearest means the
    fewest edits, at most two, a swap of neighbours counting as one edit beside
    others too; then the most frequent; then the first in the alphabet.

    Words meet in hashed deletion keys. Only those without a word one edit away
    are asked for words two edits away, which takes the longer list of keys.
    """
    words = words.select("word").distinct()
    # counted once from the corpus, then read several times
    vocabulary = materialize(vocabulary.select("word", "n"), "vocabulary")
    known = vocabulary.select(F.col("word").alias("candidate"), "n")
    unknown = materialize(words.join(vocabulary.select("word"), "word", "left_anti"), "unknown")
    w, c = F.col("word"), F.col("candidate")
    one = materialize(_choice(spelling_candidates(unknown, known, 1), _one_edit(w, c)), "one-edit")
    rest = materialize(unknown.join(one, "word", "left_anti"), "rest")
    two = _choice(spelling_candidates(rest, known, 2), _two_edits(w, c))
    best = one.unionByName(two)
    return words.join(best, "word", "left").select("word", F.coalesce("found", "word").alias("correction"))
