"""Near-duplicates by word-shingle similarity, found with SimHash fingerprints.

At five words and a Jaccard similarity of 0.8, two 64-bit fingerprints differ
in about ten bits, too many for bands of equal bits. So rows are routed by
min-hash bands (three min-hashes each, ``BANDS`` bands: a pair at 0.8 shares a
band with probability above 0.999); rows with a band in common are candidates.

Two steps. First the likely links: inside a route the Gray-order index of
:mod:`tessera.llm.simhash` finds fingerprints of 256 bits within ``RADIUS`` bits,
and the likeliest spanning forest, so links never outnumber rows, is checked on
exact shingle sets. That step may miss links and is there to be cheap. Then the
rest: in every route where checked links leave more than one component, all
candidates across components are compared on exact shingle sets, whatever their
fingerprints, so the components are those of all candidates.

In the first step a route with over ``LIMIT`` rows is dealt out in salted parts;
each part sends on one row of each of its components, until the route fits. In
the second it is dealt out in parts of about ``BLOCK`` rows, and parts are
compared with each other but for those of its largest component.

Edge cases: null texts count as empty; texts with fewer words than a shingle are
one shingle; texts without words, and texts that are equal, are near each
other. Rows without id take part; repeated rows are copies of each other. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm.simhash import gray_rank, groups_of, majority, mixed, near_pairs, shingle_hashes

BANDS, ROWS = 12, 3
WORDS = 4
RADIUS = 58
LIMIT = 1024
BLOCK = 1024
ROUNDS = 4
NODE = common.private("node")
_PRINTS = [f"w{k}" for k in range(WORDS)]


def node(col):
    """A text's place in the graph: the hash of its whole content with A-Z in lower case."""
    return F.xxhash64(common.lower_ascii(col))


def signatures(rows: DataFrame, shingle: int) -> DataFrame:
    """(node, w0.., bands) of rows (node, text); texts without words have no bands."""
    names = ["node", *_PRINTS, "bands"]

    def run(batches):
        for b in common.rows_of(batches):
            prints = np.zeros((b.num_rows, WORDS), np.uint64)
            bands: list[np.ndarray | None] = []
            for k, text in enumerate(b.column(1).to_pylist()):
                h = np.unique(shingle_hashes(text, shingle))
                if not len(h):
                    bands.append([])
                    continue
                prints[k] = [majority(mixed(h, s)) for s in range(WORDS)]
                least = np.array([mixed(h, 100 + s).min() for s in range(BANDS * ROWS)], np.uint64).reshape(BANDS, ROWS)
                bands.append([xxhash.xxh64_intdigest(row.tobytes(), k) - 2**63 for k, row in enumerate(least)])
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(prints[:, s].view(np.int64).copy()) for s in range(WORDS)), pa.array(bands, pa.list_(pa.int64()))], names)

    kinds = ", ".join(f"{w} long" for w in _PRINTS)
    return rows.mapInArrow(common.tidied(run), f"node long, {kinds}, bands array<long>")


def forest(codes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (i, j) of a minimum spanning forest under ``radius`` bits, and each row's component."""
    n = len(codes)
    labels = np.arange(n)
    parts = list(near_pairs(codes, radius))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), labels
    i, j, apart = (np.concatenate(x) for x in zip(*parts, strict=True))
    out_i, out_j = [], []
    for d in np.unique(apart):
        a, b = i[apart == d], j[apart == d]
        fresh = labels[a] != labels[b]
        a, b = a[fresh], b[fresh]
        parent: dict[int, int] = {}

        def find(x: int, parent=parent) -> int:
            while (up := parent.get(x, x)) != x:
                x = up
            return x

        for x, y, lx, ly in zip(a.tolist(), b.tolist(), labels[a].tolist(), labels[b].tolist(), strict=True):
            rx, ry = find(lx), find(ly)
            if rx != ry:
                parent[max(rx, ry)] = min(rx, ry)
                out_i.append(x)
                out_j.append(y)
        if len(a):
            labels = common.union_pairs(labels, a, b)
    return np.array(out_i, np.int64), np.array(out_j, np.int64), labels


def route_links(rows: DataFrame, radius: int, limit: int | None, lead: bool) -> DataFrame:
    """Links of all groups (band, part) of rows (band, part, node, w0.., rank); with ``lead`` also a row (node, node) for each component."""

    def run(batches):
        for band, nodes, *words in groups_of(batches, 2, limit):
            codes = np.stack(words, axis=1).view(np.uint64)
            i, j, labels = forest(codes, radius)
            a, b = nodes[i], nodes[j]
            if lead:
                tops = nodes[labels == np.arange(len(labels))]
                a, b = np.r_[a, tops], np.r_[b, tops]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), band[0])), pa.array(a), pa.array(b)], ["band", "a", "b"])

    dealt = rows.repartition("band", "part").sortWithinPartitions("band", "part", "rank", "node")
    return dealt.select("band", "part", F.col("band").alias("same"), "node", *_PRINTS).mapInArrow(common.tidied(run), "band long, a long, b long")


def likely_links(signed: DataFrame, radius: int = RADIUS, limit: int = LIMIT) -> DataFrame:
    """(a, b): links between nodes that a spanning forest of each route has."""
    rows = signed.select("node", *_PRINTS, F.explode("bands").alias("band"), gray_rank(F.col("w0")).alias("rank"))
    links = [route_links(rows.withColumn("part", F.lit(0).cast("long")), radius, limit, False).select("a", "b")]
    sizes = common.cut(rows.groupBy("band").count().where(F.col("count") > limit), "hot-routes")
    for again in range(ROUNDS):
        n = sizes.count()
        if not n:
            break
        hot = rows.join(common.sized(sizes, n), "band")
        last = again == ROUNDS - 1
        # What is left after the last round differs within its routes and is searched as it is.
        parts = F.ceil(F.col("count") / (limit // 2))
        hot = hot.withColumn("part", F.lit(0).cast("long") if last else F.pmod(F.xxhash64("node", F.lit(again)), parts))
        found = common.cut(route_links(hot.drop("count"), radius, None, not last), "route-links")
        links.append(found.where("a <> b").select("a", "b"))
        if last:
            break
        tops = found.where("a = b").select("band", F.col("a").alias("node"))
        rows = common.cut(rows.join(tops, ["band", "node"], "left_semi"), "leaders")
        sizes = common.cut(rows.groupBy("band").count().where(F.col("count") > 1), "left-routes")
        fits = sizes.where(F.col("count") <= limit)
        few = fits.count()
        if few:
            small = rows.join(common.sized(fits.select("band"), few), "band", "left_semi")
            links.append(route_links(small.withColumn("part", F.lit(0).cast("long")), radius, None, False).select("a", "b"))
        sizes = sizes.where(F.col("count") > limit)
    out = links[0]
    for more in links[1:]:
        out = out.union(more)
    return out.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of texts (node, text): the set of shingles, sorted."""

    def sets(batches):
        for b in common.rows_of(batches):
            out = [np.unique(shingle_hashes(t, shingle) >> np.uint64(24)).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["node", "shingles"])

    return texts.mapInArrow(common.tidied(sets), "node long, shingles binary")


def checked(links: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """The links whose texts' shingle sets have at least ``threshold`` Jaccard similarity; ``texts``: (node, text), one row a node."""

    def near(batches):
        for b in common.rows_of(batches):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(p) + len(q) - len(np.union1d(p, q))
                keep.append(both >= threshold * (len(p) + len(q) - both) - 1e-9)
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    held = common.cut(shingle_sets(texts, shingle), "shingles")
    a, b = (held.select(F.col("node").alias(x), F.col("shingles").alias(f"{x}_set")) for x in "ab")
    return links.join(a, "a").join(b, "b").select("a", "b", "a_set", "b_set").mapInArrow(common.tidied(near), "a long, b long")


def links_across(labels: np.ndarray, sets: list[np.ndarray], bands: np.ndarray, band: int, sides: np.ndarray | None, threshold: float) -> tuple[list[int], list[int]]:
    """Links (i, j) that join the components ``labels`` of a route's rows as all its candidates do.

    Every pair of rows is compared but for those in one component, those that an
    earlier band (column of ``bands``) has as well and, given ``sides``, those on one side.
    """
    n = len(sets)
    sizes = np.array([len(x) for x in sets])
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    mine = np.zeros(len(known), bool)
    _, first, labels = np.unique(labels, return_index=True, return_inverse=True)
    labels = first[labels]
    out_i, out_j = [], []
    for i in range(n - 1):
        rest = labels[i + 1 :] != labels[i]
        if sides is not None:
            rest &= sides[i + 1 :] != sides[i]
        # What two sets share is at most the smaller one, what they make together at least the larger.
        rest &= np.minimum(sizes[i + 1 :], sizes[i]) >= threshold * np.maximum(sizes[i + 1 :], sizes[i]) - 1e-9
        if band and rest.any():
            rest &= ~(bands[i + 1 :, :band] == bands[i, :band]).any(axis=1)
        j = np.flatnonzero(rest) + i + 1
        if not len(j):
            continue
        own = flat[starts[i] : starts[i] + sizes[i]]
        mine[own] = True
        both = np.array([np.count_nonzero(mine[flat[starts[x] : starts[x] + sizes[x]]]) for x in j])
        mine[own] = False
        near = j[both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9]
        if len(near):
            out_i += [i] * len(near)
            out_j += near.tolist()
            labels = common.union_pairs(labels, np.full(len(near), i), near)
    return out_i, out_j


def blocks(members: DataFrame, block: int) -> DataFrame:
    """``members`` (k, band, node, component) with part, low and high: pairs of parts that hold all pairs of rows across components.

    Routes of at most ``block`` rows are one part. Of others the largest component
    and the other rows are dealt out apart; the largest needs no look at itself.
    """
    counts = members.groupBy("k", "band", "component").agg(F.count("*").alias("n"))
    shape = counts.groupBy("k", "band").agg(F.sum("n").alias("size"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("main"))
    shape = common.cut(shape.where(F.col("size") > block), "hot-open-routes")
    rows = members.join(common.sized(shape, shape.count()), ["k", "band"], "left")
    major = F.coalesce(F.col("component") == F.col("main"), F.lit(False))
    few = F.coalesce(F.ceil((F.col("size") - F.col("most")) / block), F.lit(1)).cast("long")
    many = F.coalesce(F.ceil(F.col("most") / block), F.lit(0)).cast("long")
    deal = F.xxhash64("node", "k")
    part = F.when(major, few + F.pmod(deal, F.greatest(many, F.lit(1)))).otherwise(F.pmod(deal, few))
    rows = rows.withColumns({"part": part, "other": F.explode(F.sequence(F.lit(0).cast("long"), F.when(major, few - 1).otherwise(few + many - 1)))})
    return rows.withColumns({"low": F.least("part", "other"), "high": F.greatest("part", "other")}).drop("size", "most", "main", "other")


def missing_links(signed: DataFrame, classes: DataFrame, rows: DataFrame, shingle: int, threshold: float, block: int = BLOCK) -> DataFrame:
    """(a, b): near candidates that join the components ``classes`` (node, component) wherever a route has several; ``rows``: (node, text)."""

    def run(batches):
        for k, parts, across, nodes, labels, bands, sets in groups_of(batches, 4, None):
            i, j = links_across(labels, [np.frombuffer(x, np.uint64) for x in sets], np.stack(bands), int(k[0]), parts if across[0] else None, threshold)
            if i:
                yield pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(nodes[j])], ["a", "b"])

    routed = signed.select("node", F.posexplode("bands").alias("k", "band")).join(common.sized(classes, classes.count()), "node", "left")
    routed = routed.withColumn("component", F.coalesce("component", "node"))
    several = routed.groupBy("k", "band").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    several = common.cut(several.select("k", "band"), "open-routes")
    members = common.cut(routed.join(common.sized(several, several.count()), ["k", "band"]), "open-members")
    nodes = common.cut(members.select("node").distinct(), "open-nodes")
    open_ = common.sized(nodes, nodes.count())
    texts = rows.join(open_, "node", "left_semi").dropDuplicates(["node"])
    held = common.cut(shingle_sets(texts, shingle).join(signed.join(open_, "node", "left_semi").select("node", "bands"), "node"), "open-shingles")
    dealt = blocks(members, block).join(held, "node").repartition("k", "band", "low", "high").sortWithinPartitions("k", "band", "low", "high", "component", "node")
    across = (F.col("low") != F.col("high")).cast("int")
    return dealt.select("k", "band", "low", "high", F.col("k").alias("column"), "part", across.alias("across"), "node", "component", "bands", "shingles").mapInArrow(common.tidied(run), "a long, b long")


def surplus(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """(node, keep, component) of texts in groups of near-duplicates; ``keep``: the one node of each group that stays, with the smallest id."""
    rows = docs.select(node(common.col(text_col)).alias("node"), F.coalesce(common.col(text_col), F.lit("")).cast("binary").alias("text"))
    signed = common.cut(signatures(rows, shingle).dropDuplicates(["node"]), "signatures")
    links = common.cut(likely_links(signed), "likely-links")
    ends = common.cut(links.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    texts = rows.join(common.sized(ends, ends.count()), "node", "left_semi").dropDuplicates(["node"])
    edges = common.cut(checked(links, texts, shingle, threshold), "links")
    classes = common.cut(common.connected_components(edges), "components")
    missing = common.cut(missing_links(signed, classes, rows, shingle, threshold), "missing-links")
    if not missing.isEmpty():
        classes = common.cut(common.connected_components(edges.union(missing)), "components")
    ids = docs.select(common.col(id_col).alias("id"), node(common.col(text_col)).alias("node"))
    members = ids.join(common.sized(classes, classes.count()), "node").groupBy("component", "node").agg(F.min("id").alias("id"))
    members = common.cut(members, "members")
    stay = members.groupBy("component").agg(F.min_by("node", F.struct(F.col("id").isNull(), "id", "node")).alias("keep"))
    return common.cut(members.join(stay, "component").select("node", (F.col("node") == F.col("keep")).alias("keep"), "component"), "near-classes")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` but for near-duplicates and copies: one row of each group stays, with the columns it came with."""
    found = surplus(docs, id_col, text_col, shingle, threshold)
    drop = found.where("NOT keep").select(F.col("node").alias(NODE))
    marked = docs.withColumn(NODE, node(common.col(text_col)))
    copies = common.cut(marked.groupBy(NODE).agg(F.count("*").alias("n")).where("n > 1").select(NODE), "copies")
    kept = marked.join(common.sized(drop, drop.count()), NODE, "left_anti")
    some = copies.count()
    if some:
        repeated = common.sized(copies, some)
        first = kept.join(repeated, NODE, "left_semi").groupBy(NODE).agg(F.min_by(F.struct(*(common.col(c) for c in docs.columns)), F.struct(common.col(id_col).isNull(), common.col(id_col))).alias("row"))
        kept = kept.join(repeated, NODE, "left_anti").select(*map(common.col, docs.columns)).unionByName(first.select("row.*"))
    return kept.select(*(common.col(c) for c in docs.columns))
