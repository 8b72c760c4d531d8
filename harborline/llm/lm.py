"""Stupid-backoff scores of documents under an n-gram model of all documents.

A token's score is ``c(p w) / c(p)`` with the longest context p for which the
n-gram is frequent enough, times ``alpha`` for each word that the context lost;
without any context it is ``c(w) / N``. A frequent n-gram's tail is as frequent,
so the logarithm is a sum over n-grams: each word weighs ``ln c(w)``, each
frequent n-gram weighs what it adds to the backoff,
``ln c(g) - ln c(front) - ln c(tail) + ln c(middle) - ln alpha`` (of a bigram
the middle's count is N), and all else is a constant for each place. So the
model is one table of (gram, weight), made by hash-partitioned counts, and
scoring joins the exploded n-grams of the documents to it and sums by document.
Weights are whole numbers of 1e-8, so sums don't depend on the order of rows.

Grams are 64-bit names. The most frequent words are named by their place in a
table of at most ``2 ** HOT_BITS`` words, which every task holds; two such words make an
exact name, all other bigrams a hash. Only grams that could make a partition
hot, those with a ``1 / HOT_SHARE`` of all tokens or more, meet their weights
before the shuffle, in a table of ``HOT_SHARE`` rows an order at most; all others
are shuffled to the hash-partitioned table and joined there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, forget, prepare, settle

#: Tokens that a task handles together.
FLUSH = 1 << 19
#: Every task holds at most 2 to this power of words for their names: 16 MB.
HOT_BITS = 20
#: A gram with one in so many of all tokens, and with HOT_LEAST, is hot.
HOT_SHARE, HOT_LEAST = 1 << 18, 64
#: Rows that a task hands over at once.
ROWS = 1 << 17
#: Weights are whole numbers of 1 / SCALE.
SCALE = 10**8
_LOW = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_BLANK = np.isin(np.arange(256), [ord(c) for c in BLANKS])
_RANDOM = np.random.default_rng(20).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_NO_GRAM = 1 << 61
_HASHED = np.uint64(1 << 63)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts, words of each text).

    Words are runs without blanks, A-Z lower-cased; a hash is a polynomial of
    random byte values, mixed.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = _LOW[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)]
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
    ends = np.flatnonzero(blank & np.concatenate(([False], ~blank[:-1])))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    longest = int((ends - starts).max())
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(longest, _BASE))), dtype=np.uint64)
    inside = np.flatnonzero(~blank)
    length = ends - starts
    first = np.cumsum(length) - length
    place = np.arange(len(inside)) - np.repeat(first, length)
    h = _mix(np.add.reduceat(_RANDOM[data[inside]] * power[place], first))
    last = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    n = np.diff(np.searchsorted(starts, last, "left"), prepend=0)
    return h, n


def _in_flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, hashes of all words, words of each document), many documents together."""
    ids, hashes, counts, size = [], [], [], 0
    for b in batches:
        texts = [t or "" for t in b.column(1).to_pylist()]
        at = 0
        while at < len(texts):
            to, chars = at, 0
            while to < len(texts) and (to == at or chars < 1 << 20):
                chars += len(texts[to])
                to += 1
            h, n = word_hashes(texts[at:to])
            ids.append(b.column(0).slice(at, to - at))
            hashes.append(h)
            counts.append(n)
            size += len(h)
            at = to
            if size >= FLUSH:
                yield pa.concat_arrays(ids), np.concatenate(hashes), np.concatenate(counts)
                ids, hashes, counts, size = [], [], [], 0
    if ids:
        yield pa.concat_arrays(ids), np.concatenate(hashes), np.concatenate(counts)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def word_counts(rows: DataFrame) -> DataFrame:
    """(h, n): the count of every word of all texts, combined where it is read."""

    def each(batches):
        for _, h, _n in _in_flushes(batches):
            words, n = np.unique(h, return_counts=True)
            yield _batch(h=words.view(np.int64), n=n)

    return rows.mapInArrow(each, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> int:
    """The least count such that ``most`` rows at most have it or more.

    Found from a histogram of sixteenths of powers of two, so the driver sees a
    thousand rows at most. Where more rows than that share the top of the
    histogram it is a count that none has.
    """
    step = F.floor(F.log2("n") * 16)
    bins = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("least"),
        F.max("n").alias("top")).orderBy(F.desc("step")).collect()
    least, held = (bins[0]["top"] + 1 if bins else 1), 0
    for b in bins:
        held += b["rows"]
        if held > most:
            break
        least = b["least"]
    return least


def _sorted_table(frame: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The two long columns of a frame of bounded size, in order of the first."""
    t = frame.toArrow()
    key, value = (c.combine_chunks().to_numpy(zero_copy_only=False) if t.num_rows else np.zeros(0, np.int64)
        for c in t.columns)
    order = np.argsort(key, kind="stable")
    return key[order], value[order]


def _found(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in the ordered table, whether it is there) of each key."""
    if not len(table):
        return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return at, table[at] == key


def _codes(hot: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Names of words: the place in the table of frequent words, else the hash as a negative number."""
    at, there = _found(hot, h.view(np.int64))
    return np.where(there, at, (h | _HASHED).view(np.int64))


def _grams(hot: np.ndarray, h: np.ndarray, n: np.ndarray, bits: int,
    order: int = 2) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places where it ends, name) of the words, of the bigrams, and so on up to ``order``."""
    words, which = np.unique(h, return_inverse=True)
    code = _codes(hot, words)[which]
    before = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)  # words that the text has before
    out = [(np.arange(len(h)), code)]
    whole = code
    for k in range(2, order + 1):
        at = np.flatnonzero(before >= k - 1)
        p, w = whole[at - 1], code[at]
        name = (_mix(_mix(p.view(np.uint64) + _BASE) * _BASE + w.view(np.uint64)) | _HASHED).view(np.int64)
        if k == 2:
            name = np.where((p >= 0) & (w >= 0), 1 << 2 * bits | p << bits | w, name)
        whole = np.zeros(len(h), np.int64)
        whole[at] = name
        out.append((at, name))
    return out


class Model:
    """Count tables of a corpus and the weights made of them; see ``train``."""

    def __init__(self, words: DataFrame, total: int, hot, weights: DataFrame):
        self.words, self.total, self.hot, self.weights = words, total, hot, weights


def _long_weights(rows: DataFrame, k: int, lower: DataFrame, hot, min_count: int, alpha: float, bits: int) -> DataFrame:
    """(gram, n, value) of the frequent ``k``-grams, k over 2; ``lower`` (gram, n, log) has all shorter grams."""

    def count(batches):
        for _, h, n in _in_flushes(batches):
            found = _grams(hot.value[0], h, n, bits, k)
            ends, name = found[k - 1]
            whole = [np.zeros(len(h), np.int64) for _ in range(k - 1)]
            for held, (at, names) in zip(whole, found, strict=False):
                held[at] = names
            gram, first, n_of = np.unique(name, return_index=True, return_counts=True)
            last = ends[first]
            yield _batch(gram=gram, front=whole[k - 2][last - 1], tail=whole[k - 2][last],
                middle=whole[k - 3][last - 1], n=n_of)

    counted = rows.mapInArrow(count, "gram bigint, front bigint, tail bigint, middle bigint, n bigint").groupBy("gram",
        "front", "tail", "middle")
    grams = settle(counted.agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    part = lambda c, sign: F.struct(F.col(c).alias("name"), F.lit(sign).alias("sign"))
    asked = grams.select("gram", "n", F.explode(F.array(part("front", -1), part("tail", -1), part("middle", 1)))
        .alias("p")).select("gram", "n", "p.name", "p.sign")
    least = most_frequent(lower, 1 << min(bits, 16))
    met = []
    for some, join in ((lower.where(F.col("n") >= least), F.broadcast),
        (lower.where(F.col("n") < least), lambda df: df)):  # the former is bounded
        met.append(asked.join(join(some.select(F.col("gram").alias("name"), "log")), "name")
            .select("gram", "n", "sign", "log"))
    logs = met[0].union(met[1]).groupBy("gram", "n").agg(F.sum(F.col("sign") * F.col("log"))
        .alias("logs"))  # what has no row counts one
    return grams.join(logs, ["gram", "n"], "left").select("gram", "n",
        (F.ln("n") - F.lit(math.log(alpha)) + F.coalesce("logs", F.lit(0.0))).alias("value"))


def train(rows: DataFrame, min_count: int = 2, alpha: float = 0.4, bits: int = HOT_BITS, order: int = 2) -> Model:
    """A model of the texts of ``rows`` (id, text): counts, then weights, written to the shared folder.

    Grams of count one have no row in ``weights``: ln 1 is 0, and such a
    bigram or longer gram backs off (unless ``min_count`` is 1).
    """
    sc = rows.sparkSession.sparkContext
    words = settle(word_counts(rows))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = most_frequent(words, 1 << bits)
    hot, hot_n = _sorted_table(words.where(F.col("n") >= least))  # a bounded number of rows
    shared = sc.broadcast((hot, np.log(hot_n)))

    def pairs(batches):
        hot = shared.value[0]
        for _, h, n in _in_flushes(batches):
            (_, code), (inner, pair) = _grams(hot, h, n, bits)
            gram, first, count = np.unique(pair, return_index=True, return_counts=True)
            named = gram > 0  # the words can be read off the name
            p, w = (pa.array(code[inner[first] - back], mask=named) for back in (1, 0))
            yield _batch(gram=gram, p=p, w=w, n=count)

    counted = rows.mapInArrow(pairs, "gram bigint, p bigint, w bigint, n bigint").groupBy("gram", "p", "w")
    bigrams = settle(counted.agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    more = math.log(max(total, 1)) - math.log(alpha)

    def weigh(batches):
        """What is known of the weight; the names of the words whose counts are not."""
        log = shared.value[1]
        for b in batches:
            gram, n = b.column(0).to_numpy(), b.column(3).to_numpy()
            named = gram > 0
            p, w = (np.where(named, own, b.column(i).fill_null(0).to_numpy()) for i,
                own in ((1, gram >> bits & (1 << bits) - 1), (2, gram & (1 << bits) - 1)))
            value, apart = np.log(n) + more, np.stack([p, w], 1)
            known = apart >= 0
            for k in (0, 1):
                value[known[:, k]] -= log[apart[known[:, k], k]]
            ends = np.concatenate(([0], np.cumsum((~known).sum(1))))
            yield _batch(gram=gram, n=n, value=value, apart=pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                pa.array(apart[~known])))

    part = bigrams.mapInArrow(weigh, "gram bigint, n bigint, value double, apart array<bigint>")
    whole = part.where(F.size("apart") == 0).select("gram", "n", "value")

    def named(batches):
        hot = shared.value[0]
        for b in batches:
            yield _batch(gram=_codes(hot, b.column(0).to_numpy().view(np.uint64)), n=b.column(1))

    alone = words.where("n > 1").mapInArrow(named, "gram bigint, n bigint").withColumn("value", F.ln("n"))
    rare = alone.where("gram < 0").select(F.col("gram").alias("word"), F.col("value").alias("log"))
    rest = part.where(F.size("apart") > 0).select("gram", "n", "value", F.explode("apart").alias("word")).join(rare,
        "word", "left")
    rest = rest.groupBy("gram", "n", "value").agg(F.sum(F.coalesce("log", F.lit(0.0))).alias("logs")).select("gram",
        "n", (F.col("value") - F.col("logs")).alias("value"))
    weights = whole.unionByName(rest).unionByName(alone)
    lower = alone.select("gram", "n", F.col("value").alias("log")).unionByName(bigrams.select("gram", "n",
        F.ln("n").alias("log")))
    for k in range(3, order + 1):
        longer = settle(_long_weights(rows, k, settle(lower), shared, min_count, alpha, bits))
        weights = weights.unionByName(longer)
        lower = lower.unionByName(longer.select("gram", "n", F.ln("n").alias("log")))
    weights = settle(weights.withColumn("value", F.round(F.col("value") * SCALE).cast("bigint")))
    forget(bigrams)
    return Model(words, total, shared, weights)


def hot_count(total: int) -> int:
    """The count from which on a gram is hot; at most ``HOT_SHARE`` grams of an order have it."""
    return max(HOT_LEAST, -(-total // HOT_SHARE))


def score_documents(docs: DataFrame, min_count: int = 2, alpha: float = 0.4, id_col: str = "doc_id",
    text_col: str = "text", bits: int = HOT_BITS, order: int = 2) -> DataFrame:
    """(id, n_tokens, log_score, mean_log_score): one row for each id.

    S(w | p) is c(p w) / c(p) if the n-gram p w of up to ``order`` words occurs
    ``min_count`` times or more in all documents, else ``alpha`` times the
    score with p one word shorter; without context it is c(w) / N. No context
    reaches over the start of a text. Rows with one id are parts of one document, a null id is an id;
    repeated rows count as often as they come. Null or blank text has no
    tokens, score 0 and a null mean. Texts of any length are read whole. An
    empty table gives an empty table. All words count, none is left out.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    model = train(rows, min_count, alpha, bits, order)
    forget(model.words)
    frequent = model.hot
    least = hot_count(model.total)
    top = rows.sparkSession.sparkContext.broadcast(_sorted_table(model.weights.where(F.col("n") >= least)
        .select("gram", "value")))  # HOT_SHARE rows an order at most

    def explode(batches):
        """A row for each occurrence of a gram that isn't hot, and one for each text with the
        weights of those that are. The latter's gram is a name that no gram has."""
        hot, (grams, values) = frequent.value[0], top.value
        for ids, h, n in _in_flushes(batches):
            found = _grams(hot, h, n, bits, order)
            gram, which = np.unique(np.concatenate([name for _, name in found]), return_inverse=True)
            at, there = _found(grams, gram)
            value = np.where(there, values[at] if len(values) else 0, 0)[which]
            doc = np.repeat(np.arange(len(n)), n)
            lost = np.bincount(np.concatenate([np.zeros(0, np.int64), *[doc[at] for at, _ in found[1:]]]),
                minlength=len(n))
            doc = np.concatenate([doc[at] for at, _ in found])
            sums = np.zeros(len(n), np.int64)
            np.add.at(sums, doc, value)
            cold = np.flatnonzero(~there[which])
            cold = cold[np.argsort(doc[cold], kind="stable")]
            own = _NO_GRAM | (_mix((np.arange(len(n)) + int(sums.sum() & 0xFFFFFFFF))
                .astype(np.uint64)) >> np.uint64(4)).astype(np.int64)
            whole = pa.StructArray.from_arrays([pa.array(c) for c in (n, lost, sums)], ["tokens", "lost", "value"])
            yield _batch(id=ids, gram=own, own=whole)
            for some in np.split(cold, range(ROWS, len(cold), ROWS)):
                yield _batch(id=ids.take(pa.array(doc[some])), gram=gram[which[some]], own=pa.nulls(len(some), whole.type))

    exploded = rows.mapInArrow(explode, f"id {kind}, gram bigint, own struct<tokens bigint, lost bigint, value bigint>")
    weighed = exploded.join(model.weights.where(F.col("n") < least).select("gram", F.col("value").alias("weight")),
        "gram", "left")
    telling = F.col("weight").isNotNull() | (F.col("gram") >= _NO_GRAM)
    n = F.col("n_tokens")
    log = F.col("sum") / F.lit(float(SCALE)) - n * F.lit(math.log(max(model.total,
        1))) + F.col("lost") * F.lit(math.log(alpha))
    return (
        weighed.where(telling)
        .groupBy("id")
        .agg(F.sum("own.tokens").alias("n_tokens"), F.sum("own.lost").alias("lost"),
            F.sum(F.coalesce("own.value", "weight")).alias("sum"))
        .select("id", "n_tokens", log.alias("log_score"))
        .withColumn("mean_log_score", F.when(n > 0, F.col("log_score") / n))
    )
