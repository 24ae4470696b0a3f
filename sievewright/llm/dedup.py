"""Op 6.  Near-duplicates by DartMinHash signatures and banded joining.

A text is the set of its five-word shingles (fewer words: one shingle of them all); each weighs one however often it
is found, as in the similarity that links are held to.  Hashed darts are thrown into each shingle's region of the weight-rank plane: a unit
cell of weight and an interval of rank gets a Poisson number of darts, drawn from the hash of shingle, cell and
interval, so equal regions of two texts hold the same darts.  Darts below the shingle's weight and below a
rank limit that gives about k ln k + 2k darts count; each falls on one of k coordinates, and the one of least
rank per coordinate is the signature.  Coordinates agree with the probability of the (weighted) Jaccard similarity.

Equal texts are one class at once and only one of them goes on.  Signatures are cut into bands; texts that share
a band are candidates, and candidates are linked when the exact Jaccard similarity of their shingle sets is 0.8
or more.  A bucket is not expanded into all its pairs: each member meets the bucket's hub, the
member that shares most buckets with most others (an original among its copies).  Buckets whose members
are not yet one component then meet further hubs, and what these leave is compared pair by pair across
components: within the join by the whole sets where both have up to 1024 shingles, else by sketches of them (least hashes
of 256 and 1024 bins, whose tests lie six and four standard deviations below the similarity), and those that agree in
full.  So components are those of all candidate links, while the pairs that come out of joins stay linear in copies.

Null texts are classes of their own, named by their ids; texts without words are alike only if equal.  Repeated rows fall
into their text's class.  Rows that share an id but not the text are classed by their texts; a class is named by the least
id that stands for one text alone, or, where it has none, by a negative number made of a digest.  Rows without an id are
classed as well.  Ties (equal ranks of hubs) go by hashes of ids.  Texts of any length are read whole.  An empty table
gives no rows; only the id and text columns are read, whatever the names of others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import buffers, drop_materialized, materialize, mix, prefix_hash, read_table, slices, span_hash, words

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
#: Rounds after the first; the last compares all that the others left.
HUBS = 3
#: Binary logarithms of the bins of the coarse and the fine sketch, and the shares of bins that must agree before two
#: sets are compared in full.  Pairs of similarity 0.8 agree in 0.8 of the bins, with standard deviations of 0.025 and
#: 0.0125, so the shares lie six and four of these below.  Sets of up to as many shingles as the fine sketch
#: has bins are held whole instead: two such sets are compared by the join itself, whatever their sketches say.
SKETCHES = ((8, 0.65), (10, 0.75))
WHOLE = 1 << SKETCHES[1][0]
#: Up to so many ids of candidates (16 bytes each) are sent to the texts; more meet them by a shuffle.
MOST_BROADCAST_IDS = 1_000_000
FIRST_RANK = 1 / 16
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, off: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index, hash and count of the different n-word shingles of each text, ordered by text and hash."""
    begin, end, first = words(data, off)
    if not len(begin):
        z = np.zeros(0, np.int64)
        return z, z.astype(np.uint64), z
    h = span_hash(prefix_hash(data), begin, end)
    size = np.diff(first)
    doc = np.repeat(np.arange(len(size)), size)
    last = first[1:][doc]
    at = np.arange(len(h))
    starts = np.flatnonzero((at + n <= last) | (at == first[:-1][doc]))
    g = np.zeros(len(starts), np.uint64)
    padded = np.concatenate([h, np.zeros(n, np.uint64)])
    for k in range(n):
        g = mix(g + _STEP + np.where(starts + k < last[starts], padded[starts + k], np.uint64(k)))
    doc = doc[starts]
    order = np.lexsort((g, doc))
    g, doc = g[order], doc[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (doc[1:] != doc[:-1])
    where = np.flatnonzero(new)
    return doc[where], g[where], np.diff(np.append(where, len(g)))


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


@lru_cache(64)
def _poisson(mean: float) -> np.ndarray:
    """Cumulative Poisson probabilities."""
    top = int(mean + 12 * math.sqrt(mean) + 20)
    i = np.arange(top + 1)
    logs = i * math.log(mean) - mean - np.concatenate([[0.0], np.cumsum(np.log(i[1:]))])
    return np.cumsum(np.exp(logs))


def _throw(doc: np.ndarray, element: np.ndarray, cell: np.ndarray, top: np.ndarray, limit: np.ndarray, begin: float, length: float, level: int) -> tuple[np.ndarray, ...]:
    """Darts of one rank interval: text, rank and id of those inside the weights and below the texts' limits."""
    seed = mix(element ^ mix(cell * np.uint64(0xD1B54A32D192ED03) + np.uint64((level + 1) * int(_STEP) % 2**64)))
    n = np.searchsorted(_poisson(length), _unit(seed), "right")
    which = np.repeat(np.arange(len(seed)), n)
    nth = (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
    dart = mix(seed[which] + (nth + np.uint64(1)) * _STEP)
    rank = begin + length * _unit(mix(dart ^ np.uint64(0xA0761D6478BD642F)))
    inside = (_unit(mix(dart ^ np.uint64(0xE7037ED1A0B428DB))) < top[which]) & (rank < limit[doc[which]])
    return doc[which[inside]], rank[inside], dart[inside]


def dart_signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, docs: int, k: int) -> np.ndarray:
    """DartMinHash signatures (docs x k ids of darts; rows of texts without elements are zero)."""
    total = np.bincount(doc, weight, docs)
    cells = np.ceil(weight).astype(np.int64)
    row = np.repeat(np.arange(len(doc)), cells)
    cell = np.arange(len(row)) - np.repeat(np.cumsum(cells) - cells, cells)
    top = np.minimum(1.0, weight[row] - cell)
    d, e, c = doc[row], element[row], cell.astype(np.uint64)
    out = np.zeros((docs, k), np.uint64)
    darts = k * math.log(k) + 2 * k
    todo = total > 0
    while todo.any():
        limit = np.where(todo, darts / np.maximum(total, 1e-300), 0.0)
        found: list = []
        begin, length, level = 0.0, FIRST_RANK, 0
        use = np.flatnonzero(todo[d])
        while len(use):
            found.append(_throw(d[use], e[use], c[use], top[use], limit, begin, length, level))
            begin, length, level = begin + length, length if level == 0 else 2 * length, level + 1
            use = use[limit[d[use]] > begin]
        where, rank, dart = (np.concatenate(x) for x in zip(*found))
        slot = where * k + (mix(dart ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(k)).astype(np.int64)
        order = np.argsort(-rank, kind="stable")
        flat = np.zeros(docs * k, np.uint64)
        flat[slot[order]] = dart[order]  # of several writes to a slot the last, of least rank, stays
        flat = flat.reshape(docs, k)
        out[todo] = flat[todo]
        todo &= (out == 0).any(1)
        darts *= 2
    return out


def band_keys(signatures: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    out = np.zeros((len(signatures), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(signatures), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * _STEP + signatures[:, b * rows + r])
        out[:, b] = h
    return out.view(np.int64)


def signature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest (null for a null text), bands (empty without words) and the number of different shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, off = buffers(part.column(1))
                doc, g, _ = shingles(data, off)
                sig = dart_signatures(doc, g, np.ones(len(g)), part.num_rows, bands * rows)
                sizes = np.bincount(doc, minlength=part.num_rows)
                keys = band_keys(sig, bands, rows)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([k if s else [] for k, s in zip(keys, sizes)], pa.list_(pa.int64())), pa.array(sizes, pa.int64())], ["doc_id", "digest", "bands", "shingles"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), text_digest(text_col).alias("digest")).mapInArrow(run, "doc_id long, digest binary, bands array<long>, shingles long")


def text_digest(text_col: str) -> Column:
    """16 bytes of SHA-256; null for a null text."""
    return F.substring(F.unhex(F.sha2(f"`{text_col}`", 256)), 1, 16)


def sketch(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    """The least hash of each of 2**bits equal ranges, its first 31 bits; empty ranges are left out."""
    edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    at = np.searchsorted(sorted_hashes, edges)
    full = at < np.append(at[1:], len(sorted_hashes))
    return (sorted_hashes[at[full]] >> np.uint64(33)).astype(np.int32)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """id, sorted shingle hashes (uint64 bytes) and their coarse and fine sketch, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                doc, g, _ = shingles(*buffers(part.column(1)))
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                sets = [g[a:b] for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array([sketch(x, SKETCHES[0][0]) for x in sets], pa.list_(pa.int32())), pa.array([(x >> np.uint64(33)).astype(np.int32) if len(x) <= WHOLE else sketch(x, SKETCHES[1][0]) for x in sets], pa.list_(pa.int32()))], ["id", "set", "sketch", "fine"])

    return docs.mapInArrow(run, "id long, set binary, sketch array<int>, fine array<int>")


def verify(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (a, b) whose shingle sets have at least the similarity, with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                out.append(common / max(1, len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], ["a", "b", "jaccard"])

    left = sets.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    right = sets.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long, jaccard double").where(F.col("jaccard") >= similarity)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 200) -> DataFrame:
    """id and the least id of its component, for the ends of the edges, written.

    Each round gives the ids a new random order, merges every id into the first of those at most two edges away and
    contracts the edges, until none is left.  Merged ids lie in one component whatever the order is; each round leaves at most a
    fraction of the ids on average, so rounds are logarithmic, also on chains.  Rounds are written to the shared
    folder; the driver sees one count of each.  Still having edges after ``most_rounds`` is an error.
    """
    both = materialize(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = both.select(F.col("u").alias("id"), F.col("u").alias("at")).distinct()
    both_now = materialize(both.where("u <> v"), "edges")
    drop_later = [both]
    for seed in range(most_rounds):
        if not both_now.limit(1).count():
            break
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(seed)).alias("h"), F.col(c).alias("id"))  # noqa: B023, E731
        near = both_now.groupBy("u").agg(F.least(F.min(rank("v")), F.min(rank("u"))).alias("m"))
        far = both_now.join(near.select(F.col("u").alias("v"), "m"), "v").groupBy("u").agg(F.min("m").alias("m"))
        into = materialize(far.select("u", F.col("m.id").alias("to")), "merged")
        ends = into.select(F.col("u").alias("v"), F.col("to").alias("to_v"))
        new = materialize(both_now.join(into, "u").join(ends, "v").where("to <> to_v").select(F.col("to").alias("u"), F.col("to_v").alias("v")).distinct(), "edges")
        labels = materialize(labels.join(into.withColumnRenamed("u", "at"), "at", "left").select("id", F.coalesce("to", "at").alias("at")), "labels")
        drop_materialized(both_now, into, *drop_later)
        both_now, drop_later = new, [labels]
    else:
        if both_now.limit(1).count():
            raise RuntimeError(f"components have not settled in {most_rounds} rounds")
    least = labels.groupBy("at").agg(F.min("id").alias("label"))
    out = materialize(labels.join(least, "at").select("id", "label"), "components")
    drop_materialized(both_now, *drop_later)
    return out


def _pairs(frame: DataFrame, x: str, y: str, similarity: float) -> DataFrame:
    """Different pairs in order, those of sizes too unlike to be similar left out."""
    kept = frame.where((F.col(x) != F.col(y)) & (F.least("n1", "n2") >= similarity * F.greatest("n1", "n2")))
    return kept.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def sketches_agree(similarity: float = SIMILARITY) -> Column:
    """Whether two texts (n, sketch, fine, each numbered 1 and 2) may have the similarity."""
    both, small = (F.size(F.array_intersect(f"{c}1", f"{c}2")) for c in ("fine", "sketch"))
    coarse = small >= SKETCHES[0][1] * F.greatest(F.size("sketch1"), F.size("sketch2"))
    whole = F.col("n1") <= WHOLE, F.col("n2") <= WHOLE
    exact = both + 2 >= similarity / (1 + similarity) * (F.col("n1") + F.col("n2"))
    return F.when(whole[0] & whole[1], exact).when(whole[0] | whole[1], coarse).otherwise(coarse & (both >= SKETCHES[1][1] * F.greatest(F.size("fine1"), F.size("fine2"))))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, digest, class_id (the least id of its class), copies (rows of the same text) and nearest (the greatest similarity found to a different text of the class) of every row."""
    table = materialize(signature_table(docs, id_col, text_col, bands, rows), "signatures")
    groups = table.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"), F.first("shingles").alias("n"))
    # a node is the least id of a text; where several texts have the same, as rows may repeat an id, a number made of the digest
    groups = materialize(groups, "texts")
    clash = materialize(groups.where("least_id is not null").groupBy("least_id").count().where("count > 1").select("least_id", F.lit(True).alias("clash")), "clashes")
    n = clash.count()
    made = -F.pmod(F.xxhash64("digest"), F.lit(1 << 62)) - 1
    if n:
        clash = F.broadcast(clash) if n <= MOST_BROADCAST_IDS else clash  # a checked size
        exact = groups.join(clash, "least_id", "left").withColumn("rep", F.when(F.col("least_id").isNull() | F.col("clash"), made).otherwise(F.col("least_id"))).drop("clash")
    else:
        exact = groups.withColumn("rep", F.coalesce("least_id", made))
    banded = exact.select("rep", "n", "digest", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    found = materialize(banded.join(shared, "key").select("key", "rep", "n", "size", "digest"), "found")
    central = found.groupBy("rep").agg(F.sum("size").alias("central"))
    ends = materialize(found.select(F.col("rep").alias("id"), "digest").distinct(), "ends")
    rows_ = materialize(found.join(central, "rep").select("key", "rep", "n", "size", F.struct("central", F.xxhash64("rep").alias("h"), "rep", "n").alias("rank")), "buckets")
    drop_materialized(found)
    hubs = rows_.groupBy("key").agg(F.max("rank").alias("hub"))
    first = materialize(_pairs(rows_.join(hubs, "key").select("rep", F.col("hub.rep").alias("hub"), F.col("n").alias("n1"), F.col("hub.n").alias("n2")), "rep", "hub", similarity), "pairs")
    wanted = F.broadcast(ends) if ends.count() <= MOST_BROADCAST_IDS else ends  # a checked size
    texts = docs.select(text_digest(text_col).alias("digest"), F.col(f"`{text_col}`").alias("text")).where("text is not null").join(wanted, "digest").select("id", "text").dropDuplicates(["id"])
    sets = materialize(shingle_sets(texts), "sets")
    done, links = first, materialize(verify(first, sets, similarity), "links")
    labels = connected_components(links)
    used = [groups, clash, rows_, ends, sets, first, links, labels]

    def mixed() -> DataFrame:
        """Rows of buckets that lie in several components."""
        known = rows_.select("key", "rep", "n", "size", "rank").join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        torn = known.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
        return materialize(known.join(torn, "key", "left_semi"), "mixed")

    for seed in range(1, HUBS + 1):
        torn = left = mixed()
        if seed == HUBS:
            # up to three members: the hubs have met all across components
            left = left.where("size > 3")
            # pairs across components whose sketches agree, each at the least key that both have
            known = sets.select(F.col("id").alias("rep"), "sketch", "fine").join(exact.select("rep", "bands"), "rep")
            todo = left.join(known, "rep")
            x, y = (todo.select("key", *[F.col(c).alias(f"{c}{i}") for c in ("rep", "n", "label", "bands", "sketch", "fine")]) for i in (1, 2))
            sizes_fit = F.least("n1", "n2") >= similarity * F.greatest("n1", "n2")
            least_key = F.array_min(F.array_intersect("bands1", "bands2")) == F.col("key")
            cand = x.join(y, "key").where((F.col("rep1") < F.col("rep2")) & (F.col("label1") != F.col("label2")) & sizes_fit & least_key & sketches_agree(similarity))
            pairs = _pairs(cand, "rep1", "rep2", similarity)
        else:
            first_hub = left.groupBy("key").agg(F.max_by("label", "rank").alias("first_label"))
            rest = left.join(first_hub, "key")
            order = F.struct(F.lit(0).cast("long").alias("central"), F.xxhash64("rep", F.lit(seed)).alias("h"), "rep", "n") if seed > 1 else F.col("rank")
            hubs = rest.where("label <> first_label").groupBy("key").agg(F.max(F.struct(order.alias("o"), "label")).alias("hub"))
            cand = left.join(hubs, "key").where("hub.label <> label").select("rep", F.col("hub.o.rep").alias("hub_rep"), F.col("n").alias("n1"), F.col("hub.o.n").alias("n2"))
            pairs = _pairs(cand, "rep", "hub_rep", similarity)
        pairs = materialize(pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        more = materialize(verify(pairs, sets, similarity), "links")
        drop_materialized(torn)
        used += [pairs, more]
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = connected_components(links)
            used.append(labels)
        done = done.unionByName(pairs)
    both = links.select(F.col("a").alias("rep"), "jaccard").unionByName(links.select(F.col("b").alias("rep"), "jaccard")).groupBy("rep").agg(F.max("jaccard").alias("nearest"))
    named = exact.join(labels.select(F.col("id").alias("rep"), "label"), "rep", "left").select("digest", "rep", "least_id", "copies", F.coalesce("label", "rep").alias("label"))
    # the class is named by its least id of its own; where no member has one, by its node
    ids = named.groupBy("label").agg(F.coalesce(F.min(F.when(F.col("rep") == F.col("least_id"), F.col("rep"))), F.min("label")).alias("class_id"))
    named = materialize(named.join(ids, "label").join(both, "rep", "left").select("digest", "class_id", "copies", "nearest"), "classes")
    drop_materialized(*used)
    known = table.where("digest is not null").select("doc_id", "digest").join(named, "digest")
    return known.unionByName(table.where("digest is null").select("doc_id", "digest", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("copies"), F.lit(None).cast("double").alias("nearest")))


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows given, of each class the one of least id (equal ids: least digest); rows without an id or a text all stay."""
    classes = near_duplicate_classes(docs, id_col, text_col).where("doc_id is not null and digest is not null")
    pairs = materialize(classes.groupBy("doc_id", "digest").agg(F.min("class_id").alias("class_id"), F.count(F.lit(1)).alias("rows")), "pairs")
    stay = pairs.groupBy("class_id").agg(F.min(F.struct("doc_id", "digest")).alias("stay")).select("stay.doc_id", "stay.digest")
    gone = materialize(pairs.join(stay, ["doc_id", "digest"], "left_anti").select(F.col("doc_id").alias("id"), "digest"), "gone")
    twice = pairs.where("rows > 1").join(stay, ["doc_id", "digest"], "left_semi").select(F.col("doc_id").alias("id"), "digest")
    names = docs.columns
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col]).alias("rest"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{id_col}`").cast("long").alias("id"), text_digest(text_col).alias("digest"))
    left = left.join(F.broadcast(gone) if gone.count() <= MOST_BROADCAST_IDS else gone, ["id", "digest"], "left_anti")  # a checked size
    if twice.limit(1).count():
        left = left.join(twice, ["id", "digest"], "left_anti").unionByName(left.join(twice, ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"]))
    return left.select(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`") for c in names])


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(read_table(spark, sf_dir, "documents")).drop("digest")
