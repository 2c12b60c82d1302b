"""N-gram Jaccard join by token-combination prefixes.

Documents whose distinct 5-word shingles (tokens) overlap by at least 80 % of
their union are linked; the result is one component id per document. Work is
on *nodes*, the distinct token sets, so copies are never paired.

1. *Possible nodes.* A node of n tokens has at most ``e = n - ceil(0.8 n)``
   tokens that a linked node lacks. So of its ``p`` smallest tokens at least
   ``p - e`` occur in another node's ``p`` smallest. Tokens are compared in one
   shuffle, to which each block sends every token once; nodes that fall short
   have no link and leave. Those left are compared once more, by all tokens.
2. *Classes.* Tokens of more than ``F`` remaining nodes are frequent, the others
   rare; rare ones come first in the order of tokens. ``F`` starts at
   ``RARE_UP_TO`` and doubles until the frequent tokens fit a broadcast of
   ``FREQUENT_TOKENS``; any ``F`` gives the same links.
3. *Signatures.* Tokens no other node has come first of all. Each of the first
   ``e + 1`` tokens that is rare and shared is a signature. If two linked nodes
   share no rare token, all rare tokens are differences, of
   which the union has at most ``E = floor(n / 4)``. So among the first
   ``2 (E - rare + 1)`` frequent tokens of both, extended from the prefix, two
   neighbours are shared: pairs of neighbouring frequent tokens are the other
   signatures. A node with more than ``e`` rare tokens needs none.
4. *Candidates and verification.* Nodes are first compared with three hubs
   of each signature they hold, exactly, on the whole sets. Components follow. Then
   all pairs of a signature that are still in different components and can reach
   80 % by their sizes are compared too, so no link between components is lost;
   the largest component of a signature is only compared with what is outside.

The contract asks for components, so pairs already connected are not compared.

Defined results: null, empty or word-less text has no set, no link, and its own
id as component (null for a null id). Fewer than five words form one token.
Repeated rows give one row each; rows of one set are one class whatever their
ids, and a class of null ids alone has a null component. Extra columns are
ignored by ``components``; ``keep_one`` returns them untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, drop_shuffles, fresh, map_batches, settled, slices, text_key
from strata.llm.shingles import mixed, set_key, shingle_sets

SIMILAR, OF = 80, 100
RARE_UP_TO = 32
# Frequent tokens broadcast at most, 8 bytes each.
FREQUENT_TOKENS = 2_000_000
# Bits of the filter of possible nodes: 16 for each, this many at most (32 MB).
FILTER_BITS = 1 << 28
# Bytes of texts that a task turns into tokens at a time.
SLICE_BYTES = 16 << 20
# Share of n that the first step looks at beyond the e + 1 tokens of a prefix.
BEYOND = 10


def _spare(n):
    """Tokens that a linked set may lack."""
    return n - (SIMILAR * n + OF - 1) // OF


def _by_node(nodes: list[int], tokens: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The tokens of a block's distinct nodes, sorted: token, owner (index of its node), first of its run, of several nodes."""
    token, owner = np.concatenate(tokens), np.repeat(np.arange(len(nodes)), [len(t) for t in tokens])
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    first = np.append(True, token[1:] != token[:-1])
    run = np.cumsum(first) - 1
    return token, owner, first, np.bincount(run)[run] > 1


def _rows(key, token, node, value, n_marks) -> pa.RecordBatch:
    """(key, token, node, value): the last ``n_marks`` rows are marks, that is tokens of several nodes of a block (node null)."""
    size = len(key)
    marks = np.arange(size) >= size - n_marks
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(token), pa.array(node, mask=marks), pa.array(value)],
                                      names=["key", "token", "node", "value"])


_COMPARED = "key long, token long, node long, value long"
# ``value`` of a row that is to be compared by its token; other rows pass by.
_COMPARE = np.iinfo(np.int64).min


def _prefix_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest tokens of each text's node, to be compared; and for each node, in ``value``, how many
    are shared inside the block less those it needs."""
    for batch in (part for whole in batches for part in slices(whole, 0, SLICE_BYTES)):
        nodes, tokens, need = [], [], []
        seen: set[int] = set()
        for found in shingle_sets(batch.column(0).to_pylist()):
            n = len(found)
            if not n or (key := set_key(found)) in seen:
                continue
            seen.add(key)
            looked = min(n, _spare(n) + max(1, -(-n // BEYOND)))
            nodes.append(key)
            tokens.append(found[:looked])
            need.append(looked - _spare(n))
        if not nodes:
            continue
        node = np.array(nodes, np.int64)
        token, owner, first, several = _by_node(nodes, tokens)
        surplus = np.bincount(owner[several], minlength=len(node)) - np.array(need)
        alone, marks = token[~several], token[first & several]
        compare = np.full(len(alone), _COMPARE)
        key = np.concatenate((node, alone, marks))
        yield _rows(key, key, np.concatenate((node, node[owner[~several]], marks)),
                    np.concatenate((surplus, compare, np.full(len(marks), _COMPARE))), len(marks))


def _all_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All tokens of distinct nodes, to be compared; those shared inside the block pass by (``value`` 0),
    as does each node's size (``value``)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(1)
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        node = batch.column(0).to_numpy()
        token, owner, first, several = _by_node(node, np.split(lists.flatten().to_numpy(), np.cumsum(sizes)[:-1]))
        alone, known, marks = token[~several], token[several], token[first & several]
        its = node[owner[several]]
        yield _rows(np.concatenate((node, its, alone, marks)), np.concatenate((node, known, alone, marks)),
                    np.concatenate((node, its, node[owner[~several]], marks)),
                    np.concatenate((sizes, np.zeros(len(known), np.int64), np.full(len(alone) + len(marks), _COMPARE))), len(marks))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """From rows sorted by key: those that pass by, and node and token of each token that another node has too.

    Of the token at a batch's end only its one node so far is carried on."""
    open_token, open_node, open_rows, open_shared = None, 0, 0, False
    none = np.empty(0, np.int64)
    for batch in batches:
        compare = batch.column(3).to_numpy() == _COMPARE
        passing = batch.filter(pa.array(~compare))
        batch = batch.filter(pa.array(compare))
        if not batch.num_rows:
            yield passing, none, none
            continue
        token = batch.column(1).to_numpy()
        marked = np.asarray(batch.column(2).is_null())
        node = batch.column(2).fill_null(0).to_numpy()
        starts = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        sizes = np.diff(np.append(starts, len(token)))
        # of unmarked rows, the smallest and largest node of each token
        low = np.minimum.reduceat(np.where(marked, np.iinfo(np.int64).max, node), starts)
        high = np.maximum.reduceat(np.where(marked, np.iinfo(np.int64).min, node), starts)
        shared = np.logical_or.reduceat(marked, starts) | (low < high)
        late = none
        if open_token != token[0]:
            open_rows = 0
        elif open_shared or shared[0] or (open_rows and open_node != low[0]):
            shared[0] = True
            late = np.full(open_rows, open_node)
            open_rows = 0
        last = len(starts) - 1
        carry = open_rows if last == 0 else 0
        hit = np.repeat(shared, sizes) & ~marked
        yield passing, np.concatenate((late, node[hit])), np.concatenate((np.full(len(late), token[0]), token[hit]))
        open_token, open_shared = token[-1], bool(shared[last])
        open_node, open_rows = (0, 0) if open_shared else (int(low[last]), carry + int(sizes[last]))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for passing, nodes, _ in _shared(batches):
        node, n = np.unique(nodes, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((passing.column(2).to_numpy(), node))),
                                          pa.array(np.concatenate((passing.column(3).to_numpy(), n)))], names=["node", "cnt"])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for passing, nodes, tokens in _shared(batches):
        size = passing.column(3).to_numpy()
        known = size == 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((passing.column(2).to_numpy(), nodes))),
             pa.array(np.concatenate((passing.column(1).to_numpy(), tokens)),
                      mask=np.concatenate((~known, np.zeros(len(nodes), bool)))),
             pa.array(np.concatenate((size, np.zeros(len(nodes), np.int64))))], names=["node", "token", "n"])


def _by_key(compared: DataFrame) -> DataFrame:
    return compared.repartition("key").sortWithinPartitions("key")


def _possible_nodes(docs: DataFrame) -> DataFrame:
    """Nodes of which enough of the smallest tokens are shared."""
    compared = map_batches(docs.select(docs["text"].cast("string")), _prefix_tokens, _COMPARED)
    counts = map_batches(_by_key(compared), _counts, "node long, cnt long")
    return counts.groupBy("node").agg(F.sum("cnt").alias("surplus")).where("surplus >= 0").select("node")


def _shared_sets(sets: DataFrame) -> DataFrame:
    """(node, n, tokens) of the nodes of which enough of all tokens are shared; only shared tokens are kept."""
    found = map_batches(_by_key(map_batches(sets, _all_tokens, _COMPARED)), _lists, "node long, token long, n long")
    held = found.groupBy("node").agg(F.max("n").alias("n"), F.sort_array(F.collect_list("token")).alias("tokens"))
    return held.where(OF * F.size("tokens") >= SIMILAR * F.col("n"))


def _node_filter(nodes: DataFrame) -> np.ndarray:
    """A bitmap of the nodes' low bits; of bounded size, and right for all that are in."""
    bits = 1 << 16
    wanted = 16 * nodes.count()
    while bits < wanted and bits < FILTER_BITS:
        bits *= 2
    place = F.col("node").bitwiseAND(bits - 1)
    words = (nodes.groupBy(F.shiftright(place, 6).alias("w"))
             .agg(F.bit_or(F.expr(f"shiftleft(1L, cast((node & {bits - 1}) & 63 as int))")).alias("b")).toArrow())
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[words["w"].to_numpy()] = words["b"].to_numpy()
    return bitmap


def _sets(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """(doc_id, key, n, node, tokens) of every row; ``key`` is that of its text, tokens only where the bitmap has the node."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        mask = len(bitmap) * 64 - 1
        for batch in (part for whole in batches for part in slices(whole, 2, SLICE_BYTES)):
            sizes, nodes, tokens = [], [], []
            for found in shingle_sets(batch.column(2).to_pylist()):
                key = set_key(found) if len(found) else None
                inside = key is not None and (int(bitmap[(key & mask) >> 6]) >> (key & 63)) & 1
                sizes.append(len(found))
                nodes.append(key)
                tokens.append(found if inside else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(tokens, pa.list_(pa.int64()))], names=["doc_id", "key", "n", "node", "tokens"])

    text = docs["text"].cast("string")
    return map_batches(docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_key(text).alias("key"), text.alias("text")),
                       run, "doc_id long, key long, n long, node long, tokens array<long>")


def _frequent(sets: DataFrame) -> np.ndarray:
    """The frequent tokens, sorted."""
    often = settled(sets.select(F.explode("tokens").alias("token")).groupBy("token")
                    .agg(F.count("*").alias("df")).where(F.col("df") > RARE_UP_TO))
    up_to = RARE_UP_TO
    while often.where(F.col("df") > up_to).count() > FREQUENT_TOKENS:
        up_to *= 2
    found = often.where(F.col("df") > up_to).select("token").toArrow().column(0).to_numpy()
    return np.sort(found)


def _signatures(sets: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(sig, paired, node, n, f, s): the node has n tokens, f of them frequent and s shared with any other."""
    shared = sets.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        for batch in batches:
            rows: list[tuple] = []
            lists = batch.column(1)
            values, offsets = lists.flatten().to_numpy(), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))
            slot = np.minimum(np.searchsorted(frequent, values), max(len(frequent) - 1, 0))
            often = frequent[slot] == values if len(frequent) else np.zeros(len(values), bool)
            for node, n, a, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), offsets[:-1].tolist(),
                                     offsets[1:].tolist(), strict=True):
                tokens, is_often = values[a:b], often[a:b]
                spare, n_often = _spare(n), int(is_often.sum())
                n_rare = n - n_often
                # a node's own tokens come first and match nothing; then the rare shared ones
                single = tokens[~is_often][:max(spare + 1 - (n - len(tokens)), 0)].view(np.uint64)
                pair = np.empty(0, np.uint64)
                if n_rare <= spare:
                    few = tokens[is_often][:2 * (max(n // 4 - n_rare, 0) + 1)].view(np.uint64)
                    pair = mixed(mixed(few[:-1]) * np.uint64(3) + few[1:])
                rows.append((node, n, n_often, len(tokens), mixed(single).view(np.int64), pair.view(np.int64)))
            if not rows:
                continue
            singles, pairs = [r[4] for r in rows], [r[5] for r in rows]
            lengths = [len(x) for x in singles] + [len(x) for x in pairs]
            repeat = lambda k: np.repeat(np.array([r[k] for r in rows] * 2, np.int64), lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(singles + pairs)),
                 pa.array(np.arange(sum(lengths)) >= sum(lengths[:len(rows)])),
                 pa.array(repeat(0)), pa.array(repeat(1)), pa.array(repeat(2)), pa.array(repeat(3))],
                names=["sig", "paired", "node", "n", "f", "s"])

    return map_batches(sets.select("node", "tokens", "n"), run, "sig long, paired boolean, node long, n long, f long, s long")


def _can_link(x: str, y: str, sep: str = "_") -> Column:
    """Sizes allow a link: by shared tokens, or by frequent ones where no rare token need be shared."""
    col = lambda side, c: F.col(f"{side}{sep}{c}" if side else c)
    most = F.when(F.col("paired"), F.least(col(x, "f"), col(y, "f"))).otherwise(F.least(col(x, "s"), col(y, "s")))
    return OF * most >= SIMILAR * (col(x, "n") + col(y, "n") - most)


def _hub_pairs(sigs: DataFrame) -> DataFrame:
    """Each node with the hubs of every signature it shares: two with the fewest tokens of their own, and any other.

    Copies edited in different places are most like the one edited least."""
    me, own = F.struct("node", "n", "f", "s"), F.col("n") - F.col("f")
    hubs = (sigs.groupBy("sig", "paired")
            .agg(F.min("node").alias("lo"), F.max("node").alias("hi"),
                 F.array(F.min_by(me, F.struct(own, F.xxhash64("node", F.lit(1)))), F.min_by(me, F.struct(own, F.xxhash64("node", F.lit(2)))),
                         F.min_by(me, F.xxhash64("node", F.lit(3)))).alias("hubs"))
            .where(F.col("lo") < F.col("hi")).drop("lo", "hi"))
    hubs = broadcast_if_small(settled(hubs))
    each = sigs.join(hubs, ["sig", "paired"]).select("paired", "node", "n", "f", "s", F.explode("hubs").alias("hub"))
    ok = (F.col("node") != F.col("hub.node")) & _can_link("", "hub", ".")
    return each.where(ok).select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def _open_pairs(sigs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs of a signature that are in different components and can link."""
    placed = settled(sigs.join(broadcast_if_small(roots), "node", "left")
                     .withColumn("root", F.coalesce("root", "node")))
    parts = placed.groupBy("sig", "paired", "root").agg(F.count("*").alias("c"))
    largest = (parts.groupBy("sig", "paired").agg(F.max_by("root", F.struct("c", "root")).alias("main"),
                                                 F.count("*").alias("parts"))
               .where("parts > 1").drop("parts"))
    largest = broadcast_if_small(settled(largest))
    rows = settled(placed.join(largest, ["sig", "paired"]).withColumn("minor", F.col("root") != F.col("main")).drop("main"))
    side = lambda x: [F.col(c).alias(f"{x}_{c}") for c in ("sig", "node", "root", "n", "f", "s")]
    left = rows.where("minor").select(F.col("paired").alias("a_paired"), *side("a"))
    right = rows.select("paired", "minor", *side("b"))
    # the conditions are part of the join, so pairs that cannot link are never put out
    pair = left.join(right, (F.col("a_sig") == F.col("b_sig")) & (F.col("a_paired") == F.col("paired"))
                     & (F.col("a_root") != F.col("b_root")) & (~F.col("minor") | (F.col("a_node") < F.col("b_node")))
                     & _can_link("a", "b"))
    return pair.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that are links, by all tokens: those that both have are among the shared ones of each."""
    pairs = broadcast_if_small(settled(pairs))
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = one.join(pairs, "a").join(two, "b").select(
        "a", "b", F.size(F.array_intersect("ta", "tb")).alias("i"), (F.col("na") + F.col("nb")).alias("s"))
    return both.where(OF * F.col("i") >= SIMILAR * (F.col("s") - F.col("i"))).select("a", "b")


def _roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; root is the smallest node of its component.

    Each round every root takes the smallest neighbouring root, chains are
    halved, and links move to the new roots; links inside a component leave.
    """
    edges = settled(links)
    roots = settled(edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
                    .withColumn("root", F.col("node")))
    while not edges.isEmpty():
        ways = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = settled(ways.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("up")))
        jump = up.select(F.col("a").alias("up"), F.col("up").alias("upper"))
        up = broadcast_if_small(settled(up.join(broadcast_if_small(jump), "up", "left")
                                        .select("a", F.coalesce("upper", "up").alias("up"))))
        moved = lambda df, c: (df.join(up.select(F.col("a").alias(c), "up"), c, "left")
                               .withColumn(c, F.coalesce("up", c)).drop("up"))
        roots = settled(moved(roots, "root"))
        edges = moved(moved(edges, "a"), "b").where(F.col("a") != F.col("b"))
        edges = settled(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return roots


def _placed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_shingles, class, component_id) of every row; ``class`` is null where there is no set."""
    possible = settled(_possible_nodes(docs))
    drop_shuffles(docs.sparkSession)
    rows = settled(_sets(docs, _node_filter(possible)))
    sets = settled(_shared_sets(rows.where(F.col("tokens").isNotNull()).dropDuplicates(["node"]).select("node", "tokens")))
    drop_shuffles(docs.sparkSession)
    sigs = settled(_signatures(sets, _frequent(sets)))
    links = settled(_links(_hub_pairs(sigs), sets))
    drop_shuffles(docs.sparkSession)
    more = _links(_open_pairs(sigs, _roots(links)), sets)
    roots = _roots(links.union(more))
    # smallest id of each node, then of each component
    least = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    least = settled(least.join(broadcast_if_small(roots), "node", "left"))
    joint = least.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("least").alias("joint"))
    final = settled(least.join(broadcast_if_small(settled(joint)), "root", "left")
                    .select("node", F.coalesce("root", "node").alias("class"), F.coalesce("joint", "least").alias("component_id")))
    own = rows.select("doc_id", "key", F.col("n").alias("n_shingles"), "node")
    linked = own.where("n_shingles > 0").join(final, "node").select("doc_id", "key", "n_shingles", "class", "component_id")
    return linked.union(own.where("n_shingles = 0").select("doc_id", "key", "n_shingles", F.lit(None).cast("long"), "doc_id"))


def components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    return _placed(docs).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is their component's: one document of each group, and all without a link.

    Rows repeated with id and text stay once. A row of null id goes if its group
    has a row with an id; of a group of null ids alone one row of the text with the
    smallest key stays. Rows of null id without a set, linked with nothing, all stay.
    """
    placed = settled(_placed(docs))
    kept_id, more, kept_key = fresh(docs, "_kept_id", "_again", "_kept_key")
    stay = placed.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(F.col("doc_id").alias(kept_id)).agg(
        (F.count("*") > 1).alias(more))
    stay = broadcast_if_small(settled(stay))
    kept = docs.join(stay, F.col("doc_id") == F.col(kept_id))
    once = kept.where(~F.col(more)).select(docs["*"])
    again = kept.where(F.col(more)).select(docs["*"]).dropDuplicates(["doc_id", "text"])
    nameless = docs.where(F.col("doc_id").isNull())
    alone = placed.where("doc_id is null and component_id is null and class is not null").groupBy("class").agg(
        F.min("key").alias(kept_key)).select(kept_key)
    one = nameless.join(broadcast_if_small(settled(alone)), text_key(nameless["text"].cast("string")) == F.col(kept_key), "left_semi")
    wordless = nameless.where(~F.coalesce(nameless["text"].cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return once.union(again).union(one.dropDuplicates(["text"])).union(wordless)


ORACLE_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
grams AS (
  SELECT DISTINCT rid, list_slice(ws, i, i + 4) AS g
  FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM cut WHERE len(ws) > 0)),
sizes AS (SELECT rid, count(*) AS n FROM grams GROUP BY rid),
common_grams AS (SELECT a.rid AS a, b.rid AS b, count(*) AS i FROM grams a JOIN grams b ON a.g = b.g AND a.rid <> b.rid GROUP BY ALL),
links AS (SELECT a, b FROM common_grams JOIN sizes x ON x.rid = a JOIN sizes y ON y.rid = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach AS (SELECT rid AS a, rid AS b FROM cut UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT r.a AS rid, min(c.doc_id) AS component_id FROM reach r JOIN cut c ON c.rid = r.b GROUP BY r.a)
SELECT c.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, l.component_id
FROM cut c JOIN least l USING (rid) LEFT JOIN sizes s USING (rid)
"""
