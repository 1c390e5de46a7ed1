"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  If two fingerprints differ
in at most three bits, then either (A) one segment is equal and another differs in at most one
bit, or (B) each segment differs in exactly one bit.  "Differs in at most one bit" becomes an
equality through the perfect binary Golay code (23, 12, 7): every 23-bit word lies within three
bits of exactly one codeword, so if y is within one bit of x, the codeword nearest to y lies
within four bits of x.  One side of the join therefore carries all codewords within four bits (one
or six of them), the other side the nearest one.  Keys are 33 to 36 bits, so buckets stay small
for billions of fingerprints, and every pair met in a bucket is verified on the full 64 bits
inside the join.  No pair within the bound is missed.

Pairs are pairs of different fingerprints.  A fingerprint has 43,744 others within three bits, and no
more than 128 can lie within three bits of one another, so pairs grow in proportion to the
fingerprints even in the densest cluster.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import components, cut, slices, stored, unused

SEGMENTS = ((0, 22), (22, 21), (43, 21))
BANDS, ROWS = 16, 4  # of least shingles, for texts that are similar by their shingles
LEADS, SPLIT = 3, 2000  # leaders of a band key; texts that are compared with one leader in a group
TILE = 1 << 20  # shingles of texts that are compared with others of a key in one group
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the (23, 12, 7) Golay code.
GENERATOR = 0b110001110101


def _remainders() -> tuple[np.ndarray, np.ndarray]:
    """Remainders modulo the generator of the low 12 and the high 11 bits of a 23-bit word."""

    def rem(x: int) -> int:
        for i in range(22, 10, -1):
            if x >> i & 1:
                x ^= GENERATOR << (i - 11)
        return x

    low = np.array([rem(i) for i in range(1 << 12)], dtype=np.int64)
    high = np.array([rem(i << 12) for i in range(1 << 11)], dtype=np.int64)
    return low, high


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(low, high) remainder tables; per remainder up to six error patterns of at most four bits,
    the lightest first; how many there are."""
    low, high = _remainders()
    masks = [sum(1 << i for i in c) for k in range(5) for c in combinations(range(23), k)]
    found: list[list[int]] = [[] for _ in range(1 << 11)]
    for m in masks:
        found[low[m & 0xFFF] ^ high[m >> 12]].append(m)
    errors = np.array([x + [x[0]] * (6 - len(x)) for x in found], dtype=np.int64)
    return low, high, errors, np.array([len(x) for x in found], dtype=np.int64)


LOW, HIGH, ERRORS, COUNT = _tables()


def codewords(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each 23-bit word the indices (12 bits) of the codewords within four bits, nearest
    first, shape (n, 6), and how many of the six count."""
    s = LOW[x & 0xFFF] ^ HIGH[x >> 12]
    return (x[:, None] ^ ERRORS[s]) >> 11, COUNT[s]


def fingerprint(text: bytes) -> int:
    """The SimHash of a UTF-8 text: A-Z lower-cased, words split at ASCII space, 3-word shingles
    with repeats (fewer words: all of them; none: 0), XXH64 with seed 42, bit set if set in more
    than half of the hashes."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    begin = np.cumsum(size + 1) - size - 1
    width = min(3, len(words))
    last = len(words) - width + 1
    a, b = begin[:last].tolist(), (begin + size)[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for k in range(0, last, 1 << 16):
        h = [digest(joined[i:j], 42) for i, j in zip(a[k : k + (1 << 16)], b[k : k + (1 << 16)])]
        bits = np.unpackbits(np.array(h, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        prints = np.array([fingerprint(t or b"") for t in texts], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints), *batch.columns[2:]], ["doc_id", "fp", *batch.schema.names[2:]])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp)``; null texts count as empty, whose fingerprint is zero."""
    kept = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return kept.mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(29)
    return rng.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


MIXERS = _mixers()


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The different hashes of a text's shingles of ``width`` words (fewer words: all of them; none:
    no shingle); words as in :func:`fingerprint`."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    begin, width = np.cumsum(size + 1) - size - 1, min(width, len(words))
    a, b = begin[: len(words) - width + 1].tolist(), (begin + size)[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[i:j]) for i, j in zip(a, b)), dtype=np.uint64, count=len(a)))


def band_keys(hashes: np.ndarray) -> list[int]:
    """``BANDS`` keys of a set of hashes.  Two sets agree in a key if in ``ROWS`` random orders they
    have the same least member, each of which has the probability of their Jaccard similarity."""
    m, c = MIXERS
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for k in range(0, len(hashes), 1 << 12):
        np.minimum(least, (hashes[k : k + (1 << 12), None] * m + c).min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS).tobytes()
    step = 8 * ROWS
    return [xxhash.xxh64_intdigest(rows[b * step : (b + 1) * step], b) - (1 << 63) for b in range(BANDS)]


def _sketches(width: int):
    """Rows ``(doc_id, fp, one, two, bands, shingles)``; the last two are null without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch, "text"):
                part = batch.slice(a, b - a)
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                prints = np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
                sets = [shingle_set(t, width) for t in texts]
                bands = pa.array([band_keys(s) if len(s) else None for s in sets], type=pa.list_(pa.int64()))
                held = pa.array([np.unique(s.astype(np.uint32)).view(np.int32) if len(s) else None for s in sets], type=pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints), part.column(2), part.column(3), bands, held], ["doc_id", "fp", "one", "two", "bands", "shingles"])

    return run


def similar(rows: DataFrame, similarity: float) -> DataFrame:
    """Links ``(a, b)`` of fingerprints of texts whose shingle sets have a Jaccard similarity of at
    least ``similarity``, from stored ``rows(fp, one, bands, shingles)``, such that all texts of such a
    similarity that agree in a band key are connected.

    First each text is compared with the ``LEADS`` leaders of its keys, which are the least texts under
    that many orders, the same for all keys.  What matches a leader of the key makes a class with it; in
    a large group of near copies that is nearly all of it.  Then :func:`_strangers` compares the texts
    outside a key's largest class with all of the key.  A text whose similarity to another is 0.8
    misses all 16 keys with a probability of 0.0002.  Every link is verified on the whole sets.
    """
    texts = rows.where("bands is not null").groupBy("one").agg(F.first("bands").alias("bands"))
    keyed = texts.select("one", F.explode("bands").alias("key"))
    leads = [F.min_by("one", F.xxhash64("one", F.lit(k))) for k in range(LEADS)]
    met = keyed.groupBy("key").agg(F.array_distinct(F.array(*leads)).alias("leads"), F.count("*").alias("n")).where("n > 1")
    met = stored(met, "met")
    # a key with more than a thousandth of all that meet isn't dealt: there are at most a thousand of them
    often = F.col("n") * 1000 > (met.agg(F.sum("n")).first()[0] or 0)
    hot = met.where(often)
    rare = keyed.join(F.broadcast(hot.select("key")), "key", "left_anti").join(met.where(~often), "key")
    members = keyed.join(F.broadcast(hot), "key").unionByName(rare)
    pairs = stored(members.select("one", F.explode("leads").alias("lead")).where("one != lead").distinct(), "pairs")
    # a leader of many texts is split, its set going to each part
    size = stored(pairs.groupBy("lead").agg(F.ceil(F.count("*") / SPLIT).cast("int").alias("parts")).where("parts > 1"), "parts")
    parts = F.coalesce("parts", F.lit(1))
    left = pairs.join(size, "lead", "left").select("one", "lead", F.pmod(F.xxhash64("one"), parts).cast("int").alias("part"))
    named = pairs.select(F.col("one")).union(pairs.select("lead")).distinct()
    sets = rows.join(named, "one", "left_semi").groupBy("one").agg(F.first(F.struct("fp", "shingles")).alias("s"))
    sets = stored(sets.select("one", "s.fp", "s.shingles"), "sets")
    lead = sets.join(size.withColumnRenamed("lead", "one"), "one", "left")
    lead = lead.select(F.col("one").alias("lead"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("fp").alias("a"), F.col("shingles").alias("x"))
    both = left.join(lead, ["lead", "part"]).join(sets.select("one", F.col("fp").alias("b"), F.col("shingles").alias("y")), "one")
    shared = F.size(F.array_intersect("x", "y"))
    matched = stored(both.where(shared >= similarity * (F.size("x") + F.size("y") - shared)).select("one", "lead", "a", "b"), "matched")
    found = matched.select("a", "b").union(_strangers(members.where(F.col("n") > LEADS + 1), matched, sets, similarity))
    return found.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _strangers(members: DataFrame, matched: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links ``(a, b)`` between different classes of a band key: ``members(one, key, leads)``, of which
    ``matched(one, lead)`` are similar; a text that matches no leader is a class of its own.

    The texts outside the largest class of a key are compared with all of its texts, in tiles of about
    ``TILE`` shingles each way, whose rows are dealt by key and tile.  Only one link of a text to each
    other class leaves a tile.  A group without classes costs the square of its size in
    products, but neither memory nor rows grow with that."""
    spread = members.select("key", "one", F.explode("leads").alias("lead"))
    hit = matched.select("one", "lead", F.lit(True).alias("hit"))
    classes = spread.join(hit, ["one", "lead"], "left").groupBy("key", "one").agg(F.coalesce(F.min(F.when(F.col("hit") | (F.col("one") == F.col("lead")), F.col("lead"))), F.col("one")).alias("class"))
    weighed = stored(classes.join(sets.select("one", F.size("shingles").cast("bigint").alias("w")), "one"), "classes")
    sizes = weighed.groupBy("key", "class").agg(F.sum("w").alias("w"), F.count("*").alias("n"))
    per = sizes.groupBy("key").agg(F.max_by("class", F.struct("n", "class")).alias("base"), F.sum("w").alias("all"), F.max_by("w", F.struct("n", "class")).alias("held"), F.count("*").alias("classes")).where("classes > 1")
    tiles = lambda c: F.ceil(c / TILE).cast("int")
    per = stored(per.select("key", "base", tiles(F.col("all")).alias("across"), F.greatest(F.lit(1), tiles(F.col("all") - F.col("held"))).alias("down")), "tiles")
    often = F.col("across") > 1
    placed = weighed.join(F.broadcast(per.where(often)), "key") if per.where(often).count() <= 1000 else weighed.join(per.where(often), "key")
    placed = placed.unionByName(weighed.join(per.where(~often), "key"))
    at = lambda n, seed: F.pmod(F.xxhash64("one", F.lit(seed)), F.col(n)).cast("int")
    whole = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    right = placed.withColumn("j", at("across", 0)).withColumn("i", whole("down"))
    left = placed.where("class != base").withColumn("i", at("down", 1)).withColumn("j", whole("across"))
    rows = left.select("key", "i", "j", "one", "class", F.lit(True).alias("left")).unionByName(right.select("key", "i", "j", "one", "class", F.lit(False).alias("left")))
    dealt = rows.join(sets, "one").select("key", "i", "j", "class", "left", "fp", "shingles")
    return dealt.groupBy("key", "i", "j").applyInArrow(_tile(similarity), "a bigint, b bigint")


def _tile(similarity: float):
    def run(table: pa.Table) -> pa.Table:
        kind, fp = (table.column(c).to_numpy() for c in ("class", "fp"))
        left = np.flatnonzero(table.column("left").to_numpy())
        right = np.flatnonzero(~table.column("left").to_numpy())
        sets = table.column("shingles").combine_chunks()
        held = [sets.values.to_numpy()[sets.offsets[i].as_py() : sets.offsets[i + 1].as_py()] for i in range(len(sets))]
        links = []
        for a in range(0, len(left), 1024):
            own = left[a : a + 1024]
            near = close([held[i] for i in own], [held[i] for i in right], similarity)
            i, j = np.nonzero(near & (kind[own][:, None] != kind[right]))
            _, first = np.unique(np.stack([i, kind[right][j]]), axis=1, return_index=True)
            links += [(fp[own[x]], fp[right[y]]) for x, y in zip(i[first], j[first])]
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return run


def close(left: list[np.ndarray], right: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sets have at least that Jaccard similarity.  Members that only one side has are counted
    but not multiplied."""
    shared = np.zeros((len(left), len(right)), dtype=np.float32)
    a, b = (np.concatenate(x) if x else np.empty(0, dtype=np.int32) for x in (left, right))
    common = np.intersect1d(a, b)
    sizes = [np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (left, right)]
    rows = [np.repeat(np.arange(len(n)), n) for n in sizes]
    for k in range(0, len(common), 2048):
        part = common[k : k + 2048]
        found = []
        for values, row, n in zip((a, b), rows, sizes):
            at = np.searchsorted(part, values)
            at[at == len(part)] = 0
            fits = part[at] == values
            one = np.zeros((len(n), len(part)), dtype=np.float32)
            one[row[fits], at[fits]] = 1
            found.append(one)
        shared += found[0] @ found[1].T
    return shared >= similarity * (sizes[0][:, None] + sizes[1] - shared)


def _keys(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(which rows, key, is this the side with all codewords) of each kind of key."""
    u = fp.view(np.uint64)
    seg = [((u >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS]
    code = [codewords(s) for s in seg]
    rows = np.arange(len(fp))
    kind = 0
    for a in range(3):
        for b in range(3):
            if a == b:
                continue
            words, count = code[b]
            base = (np.int64(kind) << 36) | (seg[a] << 12)
            for k in range(6):
                own = rows[count > k]
                yield own, base[own] | words[own, k], True
            yield rows, base | words[:, 0], False
            kind += 1
    (w0, n0), (w1, n1), (w2, n2) = code
    base = np.int64(kind) << 36
    for i in range(6):
        for j in range(6):
            own = rows[(n0 > i) & (n1 > j)]
            yield own, base | w0[own, i] << 24 | w1[own, j] << 12 | w2[own, 0], True
    for k in range(6):
        own = rows[n2 > k]
        yield own, base | w0[own, 0] << 24 | w1[own, 0] << 12 | w2[own, k], False


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        for own, key, wide in _keys(fp):
            if len(own):
                yield pa.RecordBatch.from_arrays([pa.array(fp[own]), pa.array(key), pa.array(np.full(len(own), wide))], ["fp", "key", "wide"])


def links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """All pairs ``(a, b)`` of different values of ``prints.fp`` that differ in at most ``bits``
    (0 to 3) bits, each once."""
    if not 0 <= bits <= 3:
        raise ValueError("the segment keys find up to three differing bits")
    # a fingerprint gives about 56 rows: dealt over all tasks before that
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = prints.select("fp").distinct().repartition(tasks, "fp").mapInArrow(_emit, "fp bigint, key bigint, wide boolean")
    left = keys.where("wide").select(F.col("fp").alias("a"), "key")
    right = keys.where("not wide").select(F.col("fp").alias("b"), F.col("key").alias("key_"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    met = left.join(right, (F.col("key") == F.col("key_")) & (F.col("a") < F.col("b")) & close)
    return met.select("a", "b").distinct()


def simhash_groups(docs: DataFrame, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``(doc_id, fingerprint, component_id)``.

    Fingerprints that differ in at most ``bits`` bits are linked; ``component_id`` is the smallest
    doc_id reachable over links, its own included.  Equal fingerprints are merged before the join,
    so copies cost nothing and are not paired.  Null and empty texts have fingerprint zero and are
    linked like any other.  A null id never becomes a component id unless its whole component has
    null ids.  Repeated rows each get a row.  An empty table gives an empty result.
    """
    return _placed(cut(fingerprints(docs, id_col, text_col)), links, bits).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _placed(prints: DataFrame, linked: Callable[[DataFrame, int], DataFrame], bits: int) -> DataFrame:
    """``prints(doc_id, fp)``, which is stored, with its other columns and ``component_id``; ``linked``
    gives the links of fingerprints."""
    least = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    found = components(linked(least, bits), least.select(F.col("fp").alias("node"), F.col("least").alias("value")))
    ids = least.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    ids = cut(ids.select("fp", F.coalesce("component", "least").alias("component_id"), "n"))
    # a fingerprint that more than a thousandth of all rows have is not dealt: there are at most a
    # thousand of them, which go to every task
    often = F.col("n") * 1000 > (least.agg(F.sum("n")).first()[0] or 0)
    hot = ids.where(often).drop("n")
    many = prints.join(F.broadcast(hot), "fp")
    few = prints.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(ids.where(~often).drop("n"), "fp")
    return many.unionByName(few)


def keep_one(docs: DataFrame, bits: int = 3, words: int = 5, similarity: float | None = 0.8) -> DataFrame:
    """``docs`` with one row of each group: of the rows with the group's smallest doc_id one.

    Texts are linked if their fingerprints differ in at most ``bits`` bits or if their sets of
    ``words``-word shingles have a Jaccard similarity of at least ``similarity`` (None: fingerprints
    only).  Three of 64 bits are few for the latter: such texts often differ in 5 to 11, beyond what
    segment keys can reach at a bearable number, so :func:`similar` looks for them.

    Rows are judged by their own text: of rows that repeat a doc_id with other texts, those that
    belong to no other group stay.  Repeated rows are copies of each other.  Rows with a null doc_id
    form no group and stay; null and empty texts are copies of each other.
    """
    one, two, fp = unused(docs, "one", "two", "fp")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = docs.where("doc_id is not null").withColumns({one: F.xxhash64(text), two: F.xxhash64(F.lit(1), text)})
    rows = known.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.col(one).alias("one"), F.col(two).alias("two"))
    if similarity is None:
        prints, linked = cut(rows.mapInArrow(_fingerprints, "doc_id bigint, fp bigint, one bigint, two bigint")), links
    else:
        table = stored(rows.mapInArrow(_sketches(words), "doc_id bigint, fp bigint, one bigint, two bigint, bands array<bigint>, shingles array<int>"), "sketches")
        prints, linked = table.select("doc_id", "fp", "one", "two"), lambda least, n: links(least, n).union(similar(table, similarity))
    # rows of the smallest id, of these the text with the least hash
    first = _placed(prints, linked, bits).where("doc_id = component_id").groupBy("component_id").agg(F.min(F.struct("one", "two")).alias("least"))
    kept = first.select(F.col("component_id").alias(fp), F.col("least.one").alias(one), F.col("least.two").alias(two))
    same = [known["doc_id"] == kept[fp], known[one] == kept[one], known[two] == kept[two]]
    stay = known.join(kept, same, "left_semi").dropDuplicates(["doc_id", one, two])
    return stay.select(docs.columns).unionByName(docs.where("doc_id is null"))
