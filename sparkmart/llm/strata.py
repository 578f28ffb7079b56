"""Ranked lexical search over an index of documents grouped by equal length normaliser.

Documents are laid out by their normaliser, so that a piece of the index holds the documents of one stratum or of a
few neighbouring ones; a hot stratum spans many pieces. Within a stratum the postings of a term are
grouped by the number of occurrences, and an impact is computed once for each such number.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.llm.common import numbered, texts_of
from sparkmart.session import settle

PIECE_DOCS = 2048  # documents of a piece at most
PIECE_POSTINGS = 1 << 20  # postings of a piece at most, but for its last document
GROUP_POSTINGS = 1 << 17  # postings that a task gathers before it hands them on
VISIT_DOCS = 256  # documents whose strata a query visits at a time, at least
BLOCK_TERMS = 1 << 18  # terms of the queries that are answered together (one query at least)
EXACT = 1 << 53  # sums below this are exact as doubles

# letters and digits of ASCII (A-Z in lower case) and all beyond it make terms; other characters part them
_PARTED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())


def _terms(rows: DataFrame, id_column: str) -> DataFrame:
    """``id, n, terms, tfs`` of each row of ``rows`` that has a term: n terms in all, each, parted by blanks, with its number.

    One text holds the terms of a row, as it takes half the memory and shuffle of a list of them.
    """
    names = ["id", "n", "terms", "tfs"]

    def batch_of(held):
        ids, n, terms, tfs = zip(*held)
        ends = np.cumsum([0, *map(len, tfs)]).astype(np.int32)
        counts = np.fromiter((c for x in tfs for c in x), np.int32, ends[-1])
        columns = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(terms, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, pa.array(counts))], names=names)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row, text in zip(batch.column("id").to_pylist(), texts_of(batch)):
                found = Counter(text.translate(_PARTED).split())
                if found:
                    held.append((row, sum(found.values()), b" ".join(found), list(found.values())))
                    size += len(found)
                if size >= GROUP_POSTINGS:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    selected = rows.select(F.col(id_column).cast("long").alias("id"), "text")
    return selected.mapInArrow(run, "id long, n long, terms string, tfs array<int>")


@dataclass
class StrataIndex:
    """An index and the counts it was built with.

    ``rows``: for each piece and term the number of documents (``df``), the largest ``impact`` and the ``strata``
    (normaliser, occurrences, places); for each piece also one row with a null term, whose ``ids`` are
    the documents by place and whose ``strata`` say which places have which normaliser.
    """

    rows: DataFrame
    documents: int
    terms: int


ROWS = (
    "piece long, term string, df long, impact long, "
    "strata array<struct<m: long, tf: long, places: array<int>>>, ids array<long>"
)


def impact_of(tf, m):
    """What an occurrence count is worth in a stratum, in millionths (whole numbers, rounded down)."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _piece_rows(piece: int, ids: list, m: np.ndarray, terms: pa.Array, tfs: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    """Index rows of documents that come in the order of their normaliser ``m``."""
    place = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    values, stratum = np.unique(m, return_inverse=True)
    coded = terms.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    kinds, tf_code = np.unique(tfs, return_inverse=True)
    key = (code * len(values) + stratum[place]) * len(kinds) + tf_code
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    group_m = values[key[first] // len(kinds) % len(values)]
    group_tf = kinds[key[first] % len(kinds)]
    group_code = key[first] // len(kinds) // len(values)
    row = np.flatnonzero(np.concatenate([[True], group_code[1:] != group_code[:-1]]))
    df = np.diff(np.concatenate([first[row], [len(key)]]))
    best = np.maximum.reduceat(impact_of(group_tf, group_m), row)
    # the row of the piece itself: every place under its normaliser
    own_first = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    strata = pa.StructArray.from_arrays(
        [
            pa.array(np.concatenate([group_m, m[own_first]])),
            pa.array(np.concatenate([group_tf, np.zeros(len(own_first), np.int64)])),
            pa.ListArray.from_arrays(
                np.concatenate([first, len(key) + own_first, [len(key) + len(m)]]).astype(np.int32),
                pa.array(np.concatenate([place, np.arange(len(m), dtype=np.int32)])),
            ),
        ],
        names=["m", "tf", "places"],
    )
    n = len(row)
    names = pa.concat_arrays([coded.dictionary.take(pa.array(group_code[row])), pa.nulls(1, pa.string())])
    ends = np.concatenate([row, [len(first), len(first) + len(own_first)]]).astype(np.int32)
    columns = [
        pa.array(np.full(n + 1, piece, np.int64)), names, pa.array([*df.tolist(), None], pa.int64()),
        pa.array([*best.tolist(), None], pa.int64()), pa.ListArray.from_arrays(ends, strata),
        pa.array([None] * n + [ids], pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["piece", "term", "df", "impact", "strata", "ids"])


def _pieces(batches):
    """Cut the rows of a task, which come by normaliser, into pieces."""
    from pyspark import TaskContext

    piece = TaskContext.get().partitionId() << 32
    ids, m, terms, tfs, sizes, held = [], [], [], [], [], 0

    def done():
        flat = pa.array([t for x in terms for t in x.split()], pa.binary()).cast(pa.string())
        counts = np.concatenate(tfs).astype(np.int64)
        return _piece_rows(piece, ids, np.array(m, np.int64), flat, counts, np.array(sizes, np.int64))

    for batch in batches:
        ends, counts = batch.column("tfs").offsets.to_numpy(), batch.column("tfs").values.to_numpy()
        columns = batch.column("id").to_pylist(), batch.column("m").to_pylist(), texts_of(batch, "terms")
        for k, (doc, stratum, found) in enumerate(zip(*columns)):
            ids.append(doc)
            m.append(stratum)
            terms.append(found)
            tfs.append(counts[ends[k] : ends[k + 1]].copy())  # not a view, so that the batch can go
            sizes.append(ends[k + 1] - ends[k])
            held += sizes[-1]
            if len(ids) >= PIECE_DOCS or held >= PIECE_POSTINGS:
                yield done()
                piece += 1
                ids, m, terms, tfs, sizes, held = [], [], [], [], [], 0
    if ids:
        yield done()


def build_index(docs: DataFrame) -> StrataIndex:
    """Index every row of ``docs`` (``doc_id, text``) that has a term.

    Terms are the longest runs of ASCII letters and digits and of characters beyond ASCII; only A-Z are lower-cased.
    The normaliser m of a document of n terms is 25 + (75 * n * N) div L, where N documents have L terms in all.
    Null and empty texts have no terms and are not counted. Rows with the same id are documents of their
    own; null ids are kept. One document is held whole by a task; pieces are bounded besides. Other
    columns are not read.
    """
    forward = numbered(_terms(docs, "doc_id"), "search-terms", "row")
    documents, total = forward.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    stratum = F.expr(f"25 + (75 * n * {documents}L) div {max(total, 1)}L")
    laid = forward.withColumn("m", stratum).repartitionByRange("m", "row").sortWithinPartitions("m", "row")
    rows = laid.select("id", "m", "terms", "tfs").mapInArrow(_pieces, ROWS)
    return StrataIndex(settle(rows, "search-index"), documents, total)


def _answers(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The k best documents of one piece for each query that visits it.

    Strata are visited by falling bound (what a document would get that had the stratum's largest impact of
    every term), and none whose bound is below the k-th best score found so far.
    """
    left, right = left.combine_chunks(), right.sort_by("query").combine_chunks()
    empty = pa.table([pa.array([], pa.int64())] * 3, names=["query", "doc_id", "score"])
    names = left.column("term").to_pylist()
    if not right.num_rows or None not in names:
        return empty
    strata = left.column("strata").combine_chunks()
    ids = left.column("ids").combine_chunks()[names.index(None)].values
    known = np.array(ids.is_valid())
    id_value = ids.fill_null(0).to_numpy()
    ends = strata.offsets.to_numpy()
    groups = strata.values
    group_m, group_tf = groups.field("m").to_numpy(), groups.field("tf").to_numpy()
    places = groups.field("places")
    place_ends, place = places.offsets.to_numpy(), places.values.to_numpy()
    values, stratum = np.unique(group_m, return_inverse=True)
    impact = impact_of(group_tf, group_m)  # once per stratum, term and number of occurrences
    length = np.diff(place_ends)
    own = names.index(None)
    docs_in = np.bincount(stratum[ends[own] : ends[own + 1]], length[ends[own] : ends[own + 1]], len(values))
    row_of = {name: i for i, name in enumerate(names) if name is not None}

    rows = np.array([row_of.get(t, -1) for t in right.column("term").to_pylist()])
    weight = right.column("weight").to_numpy()
    floor = right.column("floor").to_numpy()
    queries = right.column("query").to_numpy()
    starts = np.flatnonzero(np.concatenate([[True], queries[1:] != queries[:-1]]))
    out = [[], [], []]
    for a, b in zip(starts, [*starts[1:], len(queries)]):
        used = rows[a:b] >= 0
        term, share = rows[a:b][used], weight[a:b][used]
        count = ends[term + 1] - ends[term]
        group = np.repeat(ends[term] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        worth = np.repeat(share, count) * impact[group]
        # largest impact of each term in each stratum: groups of a term come by stratum and rising occurrences
        owner = np.repeat(np.arange(len(term)), count)
        last = np.ones(len(group), bool)
        last[:-1] = (owner[1:] != owner[:-1]) | (stratum[group[1:]] != stratum[group[:-1]])
        bound = np.zeros(len(values), np.int64)
        np.add.at(bound, stratum[group[last]], worth[last])
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] >= max(1, floor[a])]
        exact = not len(order) or bound[order[0]] < EXACT
        best_score, best_id, best_known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        at = 0
        while at < len(order) and (len(best_score) < k or bound[order[at]] >= best_score[-1]):
            upto = at + 1 + int(np.searchsorted(np.cumsum(docs_in[order[at:]]), VISIT_DOCS))
            visit = np.zeros(len(values), bool)
            visit[order[at:upto]] = True
            at = upto
            chosen = visit[stratum[group]]
            g, points = group[chosen], worth[chosen]
            many = length[g]
            where = place[np.repeat(place_ends[g] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
            if exact:
                score = np.bincount(where, np.repeat(points, many).astype(float), len(id_value)).astype(np.int64)
            else:
                score = np.zeros(len(id_value), np.int64)
                np.add.at(score, where, np.repeat(points, many))
            hit = np.flatnonzero(score > 0)
            best_score = np.concatenate([best_score, score[hit]])
            best_id, best_known = np.concatenate([best_id, id_value[hit]]), np.concatenate([best_known, known[hit]])
            top = np.lexsort((best_id, ~best_known, -best_score))[:k]
            best_score, best_id, best_known = best_score[top], best_id[top], best_known[top]
        out[0].append(np.full(len(best_score), queries[a]))
        out[1].append(pa.array(best_id, mask=~best_known))
        out[2].append(best_score)
    return pa.table(
        [pa.array(np.concatenate(out[0])), pa.concat_arrays(out[1]), pa.array(np.concatenate(out[2]))],
        names=["query", "doc_id", "score"],
    )


def _visit(index: StrataIndex, asked: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """``query, doc_id, score`` of the best of each (``query, piece, floor``) of ``pairs``."""
    terms = asked.select("term").distinct()
    rows = index.rows.select("piece", "term", "strata", "ids")
    wanted = rows.join(terms, "term", "left_semi").unionByName(rows.where("term is null"))
    wanted = wanted.join(pairs.select("piece").distinct(), "piece", "left_semi")
    told = pairs.join(asked, "query").select("piece", "query", "term", "weight", "floor")
    return (
        wanted.groupBy("piece")
        .cogroup(told.groupBy("piece"))
        .applyInArrow(lambda left, right: _answers(left, right, k), "query long, doc_id long, score long")
    )


def search(index: StrataIndex, queries: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the k best documents of each query (``item_id, text``), by falling score.

    The score sums floor(1000 * ln((2 * N + 2) / (2 * df + 1))) times the impact of its occurrences over the terms
    of the query, repeats included. Equal scores stand by ascending id, null ids last; documents without a score above
    0 are not returned, so a query without a term that is found returns nothing (null and empty texts too). Each row of ``queries`` is a
    query of its own, also if its id repeats or is null. Queries are answered in blocks of about BLOCK_TERMS terms; a
    query visits its most promising piece first, then each piece whose bound reaches its k-th best score there.
    """
    items = numbered(queries.select("item_id", "text"), "search-queries", "query")
    terms = _terms(items, "query").withColumn("terms", F.split("terms", " "))
    terms = terms.select(F.col("id").alias("query"), F.explode(F.arrays_zip("terms", "tfs")).alias("x"))
    said = settle(terms.select("query", F.col("x.terms").alias("term"), F.col("x.tfs").cast("long").alias("repeats")), "search-asked")
    parts = index.rows.where("term is not null").join(said.select("term").distinct(), "term", "left_semi")
    parts = settle(parts.select("piece", "term", "df", "impact"), "search-bounds")
    rarity = F.floor(1000 * F.log(F.lit(2.0 * index.documents + 2) / (2 * F.col("df") + 1)))
    weights = parts.groupBy("term").agg(F.sum("df").alias("df")).select("term", rarity.cast("long").alias("rarity"))
    asked = said.join(weights, "term").select("query", "term", (F.col("repeats") * F.col("rarity")).alias("weight"))
    asked = settle(asked, "search-weights")
    blocks = max(1, -(-asked.count() // BLOCK_TERMS))
    found = []
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block) if blocks > 1 else asked
        bounds = mine.join(parts, "term").groupBy("query", "piece").agg(F.sum(F.col("weight") * F.col("impact")).alias("bound"))
        bounds = settle(bounds.where("bound > 0"), "search-pieces")
        first = bounds.groupBy("query").agg(F.max(F.struct("bound", -F.col("piece"))).alias("top"))
        first = settle(first.select("query", (-F.col("top.col2")).alias("piece"), F.lit(1).cast("long").alias("floor")), "search-first")
        near = settle(_visit(index, mine, first, k), "search-near")
        kth = near.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        floor = F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(1)).cast("long")
        rest = bounds.join(kth, "query").withColumn("floor", floor).where("bound >= floor")
        rest = rest.join(first.select("query", "piece"), ["query", "piece"], "left_anti").select("query", "piece", "floor")
        found += [near, _visit(index, mine, rest, k)]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = every.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(items.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
