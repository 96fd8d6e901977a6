"""Near-duplicate documents by DartMinHash signatures and banding.

A text is a weighted set: its shingles of five words, weighted by how often they
occur. Each unit of weight of an element is a strip of the plane; hashed darts
fall on it at ranks that form a Poisson process, so a document of total weight W
needs only the darts below a rank of about k (ln k + 3) / W. A dart votes for
one of k coordinates and the lowest rank wins it. Two signatures agree in a
coordinate with the probability of their weighted Jaccard similarity.

Equal texts form one class before anything is compared. Signatures are cut into
bands; classes that share a band's value are candidates. A bucket is not
expanded into pairs: its members are compared with one pivot, and the pairs that
hold are merged into components. Buckets that still touch several components are
compared in blocks of bounded size, where only links that join components come
out. Every candidate pair was then compared or lies within one component, so no
link between components is lost.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import mix, ready, small_side, stored, text_slices, word_hashes, word_spans
from tidewatch.llm.graph import components

WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 4
SIZE = BANDS * ROWS
# Share of coordinates in which a candidate pair must agree to be compared exactly.
LEAST = 0.55
# Shingles of the members that one task compares at once, for each of two sides.
BLOCK_UNITS = 1_000_000

_PLACES = mix(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)
_GAP, _DART, _AGAIN, _PLACE = (mix(np.array([s], np.uint64))[0] for s in (11, 12, 13, 14))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit ids, document of each) of a slice of texts, sorted inside each document.

    The n-th occurrence of a shingle has an id of its own, so the plain Jaccard
    similarity of two documents' ids is the weighted one of their shingles. A
    text of one to four words is one shingle; a text without words has none.
    """
    starts, ends, doc = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words = word_hashes(data, starts, ends)
    padded = np.concatenate((words, np.zeros(WORDS - 1, np.uint64)))
    after = np.concatenate((doc, np.full(WORDS - 1, -1, np.int64)))
    total, n = np.zeros(len(words), np.uint64), len(words)
    for j in range(WORDS):
        total += np.where(after[j : j + n] == doc, padded[j : j + n], np.uint64(0)) * _PLACES[j]
    first = np.ones(n, bool)
    first[1:] = doc[1:] != doc[:-1]
    use = (after[WORDS - 1 : WORDS - 1 + n] == doc) | (first & (np.bincount(doc, minlength=len(offsets) - 1)[doc] < WORDS))
    ids, doc = mix(total[use]), doc[use]
    edges = np.searchsorted(doc, np.arange(len(offsets)))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        ids[a:b].sort()
    same = np.zeros(len(ids), bool)
    same[1:] = (ids[1:] == ids[:-1]) & (doc[1:] == doc[:-1])
    if same.any():
        at = np.arange(len(ids))
        run = at - np.maximum.accumulate(np.where(same, 0, at))
        ids = np.where(same, mix(ids + run.astype(np.uint64) * _AGAIN), ids)
    return ids, doc


def signatures(ids: np.ndarray, doc: np.ndarray, docs: int, size: int = SIZE, part: np.ndarray | None = None) -> np.ndarray:
    """The (docs, size) signatures; rows of documents without elements stay 0.

    ``ids`` are strips of weight 1; ``part`` cuts a strip to a share of it (for
    weights that are no whole numbers): a dart above the share misses.
    """
    part = np.ones(len(ids)) if part is None else part
    weight = np.bincount(doc, weights=part, minlength=docs)
    out = np.zeros(docs * size, np.uint64)
    filled = np.zeros(docs * size, bool)
    limit = np.zeros(docs)
    limit[weight > 0] = size * (math.log(size) + 3) / weight[weight > 0]
    todo = weight > 0
    while todo.any():
        live = np.flatnonzero(todo[doc])
        rank, darts, at, step = np.zeros(len(live)), [], [], 0
        ranks = []
        while len(live):
            tick = np.array([step], np.uint64) * _AGAIN
            draw = (mix((ids[live] ^ _GAP) + tick) >> np.uint64(11)).astype(np.float64)
            rank = rank - np.log((draw + 0.5) * 2.0**-53)
            stay = rank < limit[doc[live]]
            live, rank = live[stay], rank[stay]
            dart = mix((ids[live] ^ _DART) + tick)
            hit = (mix(dart ^ _PLACE) >> np.uint64(11)).astype(np.float64) * 2.0**-53 < part[live]
            ranks.append(rank[hit])
            darts.append(dart[hit])
            at.append(doc[live][hit] * size + (dart[hit] % np.uint64(size)).astype(np.int64))
            step += 1
        ranks, darts, at = np.concatenate(ranks), np.concatenate(darts), np.concatenate(at)
        # Of equal places the last written stays, so ranks go from high to low.
        order = np.argsort(-ranks, kind="stable")
        out[at[order]] = darts[order]
        filled[at] = True
        todo &= ~filled.reshape(docs, size).all(axis=1)
        limit[todo] *= 2
    return out.reshape(docs, size)


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, digest, bands, signature) of every document; bands is null without words.

    The signature holds 16 bits of each coordinate.
    """

    def sketch(batches):
        turn = mix(np.arange(1, SIZE + 1, dtype=np.uint64)).reshape(BANDS, ROWS) | np.uint64(1)
        for batch in batches:
            bands = np.zeros((batch.num_rows, BANDS), np.int64)
            none, short = np.ones(batch.num_rows, bool), []
            for a, b, data, offsets in text_slices(batch.column(2)):
                ids, doc = shingles(data, offsets)
                drawn = signatures(ids, doc, b - a)
                low = drawn.astype(np.uint16).tobytes()
                short += [low[i : i + 2 * SIZE] for i in range(0, len(low), 2 * SIZE)]
                drawn = drawn.reshape(b - a, BANDS, ROWS)
                bands[a:b] = mix((drawn * turn).sum(axis=2, dtype=np.uint64)).view(np.int64)
                none[a:b] = np.bincount(doc, minlength=b - a) == 0
            cells = pa.ListArray.from_arrays(
                pa.array(np.arange(0, BANDS * batch.num_rows + 1, BANDS), pa.int32()), pa.array(bands.ravel()), mask=pa.array(none)
            )
            columns = [batch.column(0), batch.column(1), cells, pa.array(short, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "bands", "signature"])

    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), F.unhex(F.md5(body)).alias("digest"), body.alias("text"))
    return rows.mapInArrow(sketch, "doc_id long, digest binary, bands array<long>, signature binary")


def unit_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, units) of the given documents (doc_id, text)."""

    def units(batches):
        for batch in batches:
            for a, b, data, offsets in text_slices(batch.column(1)):
                ids, doc = shingles(data, offsets)
                edges = np.searchsorted(doc, np.arange(b - a + 1))
                lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "units"])

    return docs.mapInArrow(units, "doc_id long, units array<long>")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """(doc_id, digest, cluster_id, kept) of every row; digest is of its text, cluster_id is the smallest id of its group.

    Equal texts are one group. Texts without a word link only with equal texts.
    A null text counts as empty. Rows that share a doc_id are each judged by
    their own text; equal ones get equal rows. A row without doc_id is compared with nothing: its
    cluster_id is null and it is kept. Extra columns are not read; an empty table
    gives no rows. Similarity is the weighted Jaccard similarity of five-word
    shingles, compared exactly for every candidate pair.
    """
    spark = ready(docs.sparkSession)
    sketched = stored(sketches(docs, text), "dart-sketches")
    named = sketched.where("doc_id IS NOT NULL")
    classes = stored(
        named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "dart-classes"
    )
    members = candidates(classes)
    found = grouped(spark, docs, classes, members, similarity, text)
    group = classes.select("digest", "rep")
    if found is not None:
        group = group.join(found.withColumnRenamed("node", "rep"), "rep", "left")
        group = group.select("digest", F.coalesce("component", "rep").alias("cluster_id"))
    else:
        group = group.select("digest", F.col("rep").alias("cluster_id"))
    ids = named.select("doc_id", "digest").join(group, "digest").select("doc_id", "digest", "cluster_id")
    alone = sketched.where("doc_id IS NULL").select("doc_id", "digest", F.col("doc_id").alias("cluster_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("cluster_id"), F.lit(True)).alias("kept")
    return ids.unionByName(alone).select("doc_id", "digest", "cluster_id", kept)


def candidates(classes: DataFrame) -> DataFrame:
    """(key, rep, n, h) of the band buckets with several classes; h orders a bucket's members at random, first is 0."""
    cells = classes.select("rep", F.posexplode("bands").alias("band", "value")).select(F.xxhash64("band", "value").alias("key"), "band", "rep")
    cells = cells.withColumn("h", F.shiftrightunsigned(F.xxhash64("rep", "key"), 1) / F.lit(float(2**63)))
    buckets = cells.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h", "rep")).alias("pivot")).where("n > 1")
    return stored(cells.join(buckets, "key"), "dart-buckets")


def similar(pairs: DataFrame, sketch: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame | None:
    """Those of the pairs (u, v) that reach the similarity, compared exactly; None where there are none.

    Pairs far below it by their signatures are left out first. Of 80 coordinates
    a pair of similarity 0.8 agrees in fewer than LEAST only once in ten million.
    """
    left, right = (sketch.select(F.col("rep").alias(end), F.col("signature").alias(f"_{end}")) for end in ("u", "v"))
    agree = F.expr(f"aggregate(sequence(1, {2 * SIZE}, 2), 0, (n, i) -> n + IF(substring(_u, i, 2) = substring(_v, i, 2), 1, 0))")
    close = stored(pairs.join(left, "u").join(right, "v").where(agree >= math.ceil(LEAST * SIZE)).select("u", "v"), "dart-pairs")
    n = close.count()
    if not n:
        return None
    ends = close.select(F.col("u").alias("doc_id")).union(close.select(F.col("v").alias("doc_id"))).distinct()
    sets = bodies.join(small_side(ends, 2 * n), "doc_id")
    left = sets.select(F.col("doc_id").alias("u"), F.col("units").alias("_a"))
    right = sets.select(F.col("doc_id").alias("v"), F.col("units").alias("_b"))
    both = close.join(left, "u").join(right, "v").withColumn("_c", F.size(F.array_intersect("_a", "_b")))
    enough = F.col("_c") >= F.lit(similarity) * (F.size("_a") + F.size("_b") - F.col("_c")) - 1e-9
    return both.where(enough).select("u", "v")


def grouped(spark, docs: DataFrame, classes: DataFrame, members: DataFrame, similarity: float, text: str) -> DataFrame | None:
    """(node, component) of all classes that have a link; None where no bucket has two classes."""
    nodes = stored(members.select(F.col("rep").alias("doc_id")).distinct(), "dart-nodes")
    n_nodes = nodes.count()
    if not n_nodes:
        return None
    near = small_side(nodes, n_nodes)
    sketch = stored(classes.select("rep", "signature", "bands").join(near, F.col("rep") == F.col("doc_id"), "left_semi"), "dart-signatures")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sets = stored(unit_sets(texts.join(near, "doc_id")), "dart-units")
    stars = spark.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))

    def take(pairs: DataFrame) -> None:
        nonlocal stars
        found = similar(pairs, sketch, sets, similarity)
        if found is not None:
            stars = components(stars.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(found))

    # First each class against the pivot it meets most often, then against its other pivots.
    met = stored(members.where("rep <> pivot.rep").groupBy("rep", F.col("pivot.rep").alias("pivot")).count(), "dart-met")
    likely = met.groupBy("rep").agg(F.max_by("pivot", F.struct("count", "pivot")).alias("pivot"))
    take(likely.select(F.col("rep").alias("u"), F.col("pivot").alias("v")))
    take(apart(met.select(F.col("rep").alias("u"), F.col("pivot").alias("v")), stars))
    # What is left: pairs inside buckets that still touch several components.
    left = opened(placed(members, stars), "component").select("key", "band", "rep", "component")
    wide = sketch.join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    sizes = left.join(wide.select("rep", F.size("units").alias("size")), "rep").groupBy("key")
    blocks = sizes.agg(F.ceil(F.sum("size") / BLOCK_UNITS).cast("int").alias("nb"))
    own = F.pmod(F.xxhash64("rep", "key"), F.col("nb").cast("long")).cast("int")
    rows = left.join(blocks, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "nb")
    links = rows.join(wide, "rep").groupBy("key", "low", "high").applyInArrow(lambda t: block_links(t, similarity), "u long, v long")
    links = stored(links, "dart-links")
    if links.isEmpty():
        return stars
    return components(stars.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(links))


def block_links(table: pa.Table, similarity: float) -> pa.Table:
    """Links that join the components met in one block of a bucket, by exact comparison; never more than components.

    A pair is looked at in the first band that both have in common, and no
    longer once its ends are in one component. Members of small components look
    for a partner, the most alike by signature first.
    """
    reps, band = table.column("rep").to_numpy(), table.column("band")[0].as_py()
    signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(len(reps), SIZE)
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(reps), BANDS)
    lists = table.column("units").combine_chunks()
    edges, units = lists.offsets.to_numpy(), lists.values.to_numpy()
    owned = table.column("own").to_numpy()
    within = table.column("low")[0].as_py() == table.column("high")[0].as_py()
    _, group, size = np.unique(table.column("component").to_numpy(), return_inverse=True, return_counts=True)
    root, out = np.arange(len(size)), ([], [])
    order = np.lexsort((np.arange(len(reps)), group, size[group]))
    rank = np.empty(len(reps), np.int64)
    rank[order] = np.arange(len(reps))
    for x in order.tolist():
        others = np.flatnonzero((root[group] != root[group[x]]) & (rank > rank[x]))
        if not within:
            others = others[owned[others] != owned[x]]
        if not len(others):
            continue
        others = others[(bands[others] == bands[x]).argmax(axis=1) == band]
        agree = (signs[others] == signs[x]).sum(axis=1)
        close = others[agree >= math.ceil(LEAST * SIZE)]
        mine = units[edges[x] : edges[x + 1]]
        for y in close[np.argsort(-agree[agree >= math.ceil(LEAST * SIZE)], kind="stable")].tolist():
            if root[group[y]] == root[group[x]]:
                continue
            theirs = units[edges[y] : edges[y + 1]]
            both = len(np.intersect1d(mine, theirs, assume_unique=True))
            if both >= similarity * (len(mine) + len(theirs) - both) - 1e-9:
                root[root == root[group[y]]] = root[group[x]]
                out[0].append(int(reps[x]))
                out[1].append(int(reps[y]))
    return pa.table({"u": pa.array(out[0], pa.int64()), "v": pa.array(out[1], pa.int64())})


def placed(members: DataFrame, stars: DataFrame) -> DataFrame:
    """The bucket members with their component so far."""
    named = members.join(stars.withColumnRenamed("node", "rep"), "rep", "left")
    return named.withColumn("component", F.coalesce("component", "rep"))


def opened(members: DataFrame, group: str) -> DataFrame:
    """The members of buckets of three or more that touch several groups; two were compared with each other."""
    sides = members.groupBy("key").agg(F.min(group).alias("_low"), F.max(group).alias("_high"), F.max("n").alias("_n"))
    return members.join(sides.where((F.col("_low") != F.col("_high")) & (F.col("_n") > 2)).select("key"), "key", "left_semi")


def apart(pairs: DataFrame, stars: DataFrame) -> DataFrame:
    """The pairs whose ends lie in different components."""
    for end in ("u", "v"):
        named = stars.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
        pairs = pairs.join(named, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    return pairs.where("_u <> _v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, and one row of rows equal in id and text."""
    decided = stored(near_duplicates(docs, similarity, text), "dart-decided")
    dropped = decided.where(~F.col("kept")).select("doc_id", "digest").distinct()
    again = decided.where("kept AND doc_id IS NOT NULL").groupBy("doc_id", "digest").count().where("count > 1").select("doc_id", "digest")
    columns = [F.col("_row").getField(c).alias(c) for c in docs.columns]
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("digest"),
    )
    kept = rows.join(small_side(dropped, dropped.count()), ["doc_id", "digest"], "left_anti")
    n_again = again.count()
    if n_again:
        single = kept.join(small_side(again, n_again), ["doc_id", "digest"], "left_anti")
        kept = single.unionByName(kept.join(small_side(again, n_again), ["doc_id", "digest"], "left_semi").dropDuplicates(["doc_id", "digest"]))
    return kept.select(*columns)
