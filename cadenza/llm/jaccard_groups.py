"""N-gram Jaccard join over groups of similar documents and their token unions.

Tokens are 64-bit hashes of five-word shingles (words lower-cased A-Z, split at
`[\\x20\\x09-\\x0D]`).  Texts of equal token sets are one node from the start.

1. *Prefixes.*  Two sets with 100 * common >= 80 * union share a token among the first
   ``n - ceil(0.8 n) + 1`` of each in any common order.  Tokens found in more than
   ``FREQUENT`` prefixes come last in the order, so common lines do not bring
   strangers together.
2. *Groups.*  The documents of a prefix token are compared with one of them only, its
   hub: as many comparisons as entries, however large the crowd.  Components of the
   accepted links are the groups of similar documents.  The hub is the document with the
   fewest tokens of its own, as the original among edited copies.  A round with
   further hubs from the largest groups join what the first ones missed.
3. *Token-group matrix.*  Where a prefix token still meets several groups, all its
   documents form the crowd of its largest group, and those outside that group query
   it.  A task holds a block of a crowd and its tokens; the union of these bounds what
   a query can share with any document, and only blocks that hold 80 % of the query's
   tokens are opened and counted document by document.

Every pair of different groups that shares a prefix token is covered by 2 or 3, hence
no link is lost.  Comparisons are exact on token sets (at 64 bits, two different
shingles among 10^9 are confused with a chance of 3 in 100).  A hub's documents are
spread over tasks by a salt; each task holds one hub's tokens and one batch.

Null, empty and blank texts have no tokens and link with nothing: their component is
their own id.  Rows repeating an id and text are one document; an id with several
texts takes part with each and gets a row for each.  A null id forms no component id
(null unless linked).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.columns import Words, blocks, byte_column, fresh, mixed, windows
from cadenza.llm.components import components
from cadenza.session import cut

WORDS = 5
#: Similarity in percent.
LEAST = 80
#: Prefixes a token may be in before it goes to the end of the order.
FREQUENT = 4
#: Most frequent tokens told to the tasks, 8 bytes each.  The order only has to be the
#: same everywhere, so tokens beyond it cost time, not links.
MOST_FREQUENT = 2_000_000
#: Documents compared with a hub in one task.
PER_SALT = 1_000
#: Rounds of comparisons with a further hub per token, before crowds are queried.
HUB_ROUNDS = 1
#: Documents of a crowd kept in one task.
PER_BLOCK = 500
#: Ids up to which a list is broadcast instead of joined through a shuffle.
BROADCAST_IDS = 2_000_000


def token_sets(column: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """The ascending distinct tokens of each text."""
    data, offsets = byte_column(column)
    for first, end in blocks(offsets):
        found = Words(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first], fold=True)
        hashed = found.hashes()
        shingles = windows(hashed, words)
        for row in range(end - first):
            a, b = found.first_word[row], found.first_word[row + 1]
            if b - a >= words:
                yield np.unique(shingles[a : b - words + 1])
            else:
                yield windows(hashed[a:b], int(b - a)) if b > a else shingles[:0]


def node_of(tokens: np.ndarray) -> int:
    """A 64-bit name of a token set."""
    total = mixed(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mixed(np.array([total ^ np.uint64(len(tokens))]))[0].astype(np.int64))


def needed(n):
    """Common tokens that a set of ``n`` needs with any similar one: ceil(0.8 n)."""
    return (LEAST * n + 99) // 100


def _possible(n: Column, rest: Column, m: Column, other_rest: Column) -> Column:
    """Can sets of ``n`` and ``m`` tokens be similar, if the first token they share
    leaves ``rest`` and ``other_rest`` of each in the order, itself included?"""
    return (100 + LEAST) * F.least(rest, other_rest) >= LEAST * (n + m)


def _digest(text: str) -> Column:
    """Tells the texts of a repeated or null id apart."""
    return F.xxhash64(F.col(text))


def nodes_of_documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, digest, n, node) of every row."""

    def run(batches):
        for batch in batches:
            nodes, sizes = [], []
            for tokens in token_sets(batch.column(1)):
                sizes.append(len(tokens))
                nodes.append(node_of(tokens) if len(tokens) else None)
            arrays = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "digest", "n", "node"])

    cases = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"), _digest(text).alias("digest"))
    return cases.mapInArrow(run, f"id {cases.schema['id'].dataType.simpleString()}, digest long, n long, node long")


def _prefixes(docs: DataFrame, text: str, frequent: np.ndarray | None) -> DataFrame:
    """(token, node, n, rest) of the prefixes, ``rest`` counting the tokens from this one on;
    a task gives those of equal texts once."""
    shared = None if frequent is None else docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        last = np.zeros(0, np.uint64) if shared is None else shared.value
        seen: set[int] = set()
        for batch in batches:
            out, nodes, sizes, rests = [], [], [], []
            for tokens in token_sets(batch.column(0)):
                n = len(tokens)
                node = node_of(tokens) if n else 0
                if not n or node in seen:
                    continue
                seen.add(node)
                if len(last):
                    late = last[np.minimum(np.searchsorted(last, tokens), len(last) - 1)] == tokens
                    tokens = np.concatenate([tokens[~late], tokens[late]])
                tokens = tokens[: n - needed(n) + 1]
                out.append(tokens)
                nodes.append(np.full(len(tokens), node, np.int64))
                sizes.append(np.full(len(tokens), n, np.int32))
                rests.append(np.arange(n, n - len(tokens), -1, dtype=np.int32))
            if out:
                arrays = [np.concatenate(out).view(np.int64), *(np.concatenate(c) for c in (nodes, sizes, rests))]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["token", "node", "n", "rest"])

    return docs.select(F.col(text).alias("body")).mapInArrow(run, "token long, node long, n int, rest int")


def frequent_tokens(docs: DataFrame, text: str) -> np.ndarray:
    counts = _prefixes(docs, text, None).groupBy("token").count().where(F.col("count") > FREQUENT)
    rows = cut(counts).orderBy(F.col("count").desc(), "token").limit(MOST_FREQUENT).select("token").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _texts(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(node, n, body) once for every wanted node."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            nodes, sizes, keep = [], [], []
            for i, tokens in enumerate(token_sets(batch.column(0))):
                node = node_of(tokens) if len(tokens) else 0
                if len(tokens) and node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sizes.append(len(tokens))
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int32()), batch.column(0).take(pa.array(keep, pa.int64()))], names=["node", "n", "body"]
            )

    named = docs.select(F.col(text).alias("body")).mapInArrow(run, "node long, n int, body string")
    return named.join(_listed(wanted), "node", "left_semi")


def _of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts of some nodes, left out of the others before anything is shuffled."""
    return texts.join(_listed(cut(nodes.distinct())), "node", "left_semi")


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (hub, node) whose token sets are similar."""
    texts = _of(texts, pairs.select("node").union(pairs.select("hub")))
    counts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PER_SALT).cast("int").alias("salts"))
    salted = pairs.join(counts, "hub").select("hub", "node", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"))
    members = salted.join(texts, "node").select("hub", "salt", F.lit(1).alias("part"), "node", "body")
    hubs = (
        counts.join(texts, counts.hub == texts.node)
        .select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("part"), "node", "body")
    )

    def run(batches):
        hub, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            kept: list[tuple[int, int]] = []
            rows = zip(batch.column("hub").to_pylist(), batch.column("part").to_pylist(), batch.column("node").to_pylist(), token_sets(batch.column("body")), strict=True)
            for key, part, node, tokens in rows:
                if part == 0:
                    hub, own = key, tokens
                elif key == hub:
                    common = len(np.intersect1d(own, tokens, assume_unique=True))
                    if 100 * common >= LEAST * (len(own) + len(tokens) - common):
                        kept.append((key, node))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.int64()), pa.array([n for _, n in kept], pa.int64())], names=["hub", "node"])

    dealt = members.unionByName(hubs).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "part")
    return dealt.select("hub", "part", "node", "body").mapInArrow(run, "hub long, node long")


def _crowds(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(crowd, node, grp, asks): the documents that meet in prefix tokens of several groups.

    A token's crowd is named after its largest group; all documents of the token belong
    to it, and those of other groups query it.  Every pair of different groups that
    shares a token so lies in one crowd, and rows are no more than entries.
    """
    placed = entries.join(groups, "node", "left").select("token", "node", F.coalesce("label", "node").alias("grp"))
    tally = placed.groupBy("token", "grp").agg(F.count("*").alias("c"))
    tops = tally.groupBy("token").agg(F.count("*").alias("grps"), F.max(F.struct("c", "grp")).alias("top"), F.sum("c").alias("all"))
    tops = tops.where("grps > 1").select("token", F.col("top.grp").alias("crowd"))
    met = placed.join(tops, "token").groupBy("crowd", "node", "grp").agg(F.lit(1).alias("one"))
    return met.select("crowd", "node", "grp", (F.col("grp") != F.col("crowd")).alias("asks"))


def queried(crowds: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (hub, node) between documents of different groups in one crowd.

    A crowd is stored in blocks of about ``PER_BLOCK`` documents.  A task keeps a block's
    tokens with the documents that have each; a query first counts the tokens it shares
    with the block's union, and only where these are enough are they counted by document.
    """
    texts = _of(texts, crowds.select("node"))
    counts = cut(
        crowds.groupBy("crowd").agg(
            F.ceil(F.count("*") / PER_BLOCK).cast("int").alias("blocks"),
            F.ceil(F.count_if("asks") / PER_SALT).cast("int").alias("salts"),
        )
    )
    placed = crowds.join(counts, "crowd")
    block, salt = (F.pmod(F.xxhash64("node", F.lit(c)), F.col(c)).cast("int") for c in ("blocks", "salts"))
    asking = placed.where("asks").select(
        "crowd", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), salt.alias("salt"), F.lit(1).alias("part"), "node", "grp"
    )
    stored = placed.select(
        "crowd", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("part"), "node", "grp"
    )

    def run(batches):
        key, names, grps, sets = None, [], [], []
        every = owner = None
        for batch in batches:
            hubs, nodes = [], []
            columns = (batch.column(c).to_pylist() for c in ("crowd", "block", "salt", "part", "node", "grp"))
            for *here, part, node, grp, tokens in zip(*columns, token_sets(batch.column("body")), strict=True):
                if here != key:
                    key, names, grps, sets, every = here, [], [], [], None
                if part == 0:
                    names.append(node)
                    grps.append(grp)
                    sets.append(tokens)
                    continue
                if not sets:
                    continue
                if every is None:
                    sizes = np.array([len(t) for t in sets])
                    owner = np.repeat(np.arange(len(sets)), sizes)
                    every = np.concatenate(sets)
                    order = np.argsort(every, kind="stable")
                    every, owner = every[order], owner[order]
                low, high = np.searchsorted(every, tokens, "left"), np.searchsorted(every, tokens, "right")
                if np.count_nonzero(high > low) < needed(len(tokens)):
                    continue
                length = high - low
                at = np.arange(length.sum()) + np.repeat(low - np.cumsum(length) + length, length)
                common = np.bincount(owner[at], minlength=len(sets))
                alike = 100 * common >= LEAST * (len(tokens) + sizes - common)
                for i in np.flatnonzero(alike).tolist():
                    if grps[i] != grp:
                        hubs.append(node)
                        nodes.append(names[i])
            yield pa.RecordBatch.from_arrays([pa.array(hubs, pa.int64()), pa.array(nodes, pa.int64())], names=["hub", "node"])

    dealt = asking.unionByName(stored).join(texts.select("node", "body"), "node")
    dealt = dealt.repartition("crowd", "block", "salt").sortWithinPartitions("crowd", "block", "salt", "part")
    return dealt.select("crowd", "block", "salt", "part", "node", "grp", "body").mapInArrow(run, "hub long, node long")


def _representatives(docs: DataFrame, named: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, bool]:
    """The documents of one id and text among equal token sets, the least, and whether some
    are repeated rows.  Other texts of a set-aside row's id stay."""
    copies = named.where("node IS NOT NULL").groupBy("node").agg(F.min(F.expr(_LEAST)).alias("first"), F.count("*").alias("times")).where("times > 1")
    copies = cut(copies.select("node", F.col("first.id").alias("first"), F.col("first.digest").alias("first_digest")))
    if copies.isEmpty():
        return docs.select(text), False
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    same = named.join(_listed(copies), "node")
    kept = F.col("id").eqNullSafe(F.col("first")) & (F.col("digest") == F.col("first_digest"))
    others = cut(same.where(~kept).select(F.col("id").alias("_id"), "digest").distinct())
    again = not same.where(kept).groupBy("node").count().where("count > 1").isEmpty()
    row = F.col("id").eqNullSafe(F.col("_id")) & (_digest("body") == F.col("digest"))
    return docs.join(_listed(others), row, "left_anti").select(F.col("body").alias(text)), again


def _hub_round(live: DataFrame, groups: DataFrame, tested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New pairs (hub, node) to compare, and the entries still open after that.

    The hub of a token is a document of its largest group; it meets all documents of the
    other groups, and needs no place among the token's entries any more.
    """
    placed = live.join(groups, "node", "left").select("token", "node", "n", "rest", F.coalesce("label", "node").alias("grp"))
    tally = placed.groupBy("token", "grp").agg(F.count("*").alias("c"), F.min(F.expr(_LEADS)).alias("hub"))
    hubs = tally.groupBy("token").agg(F.count("*").alias("grps"), F.max(F.struct("c", "grp", "hub")).alias("top")).where("grps > 1")
    hubs = hubs.select("token", F.col("top.grp").alias("hub_grp"), *_hub("top.hub"))
    met = cut(placed.join(hubs, "token").where("node <> hub"))
    pairs = met.where("grp <> hub_grp").where(_WITH_HUB).select("hub", "node").distinct()
    return cut(pairs.join(tested, ["hub", "node"], "left_anti")), met.select("token", "node", "n", "rest")


def _hub(column: str) -> list[Column]:
    return [F.col(f"{column}.{c}").alias(name) for c, name in (("node", "hub"), ("n", "hub_n"), ("rest", "hub_rest"))]


#: The order in which entries are chosen as hubs: with the fewest tokens of their own
#: before this one, as the original among edited copies has.
_LEADS = "struct(n - rest AS own, node, n, rest)"
#: The row kept of a component: ids before null, least id, least digest.
_LEAST = "struct(id IS NULL AS none, id, digest)"
#: `_possible` of a document and its token's hub.
_WITH_HUB = f"{100 + LEAST} * least(rest, hub_rest) >= {LEAST} * (n + hub_n)"


def _groups(links: DataFrame) -> DataFrame:
    return components(links.select(F.col("hub").alias("a"), F.col("node").alias("b")))


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, digest, n, label) of every row; label is the component, null without tokens."""
    named = cut(nodes_of_documents(docs, doc_id, text))
    first_docs, again = _representatives(docs, named, doc_id, text)
    frequent = frequent_tokens(first_docs, text)
    dealt = _prefixes(first_docs, text, frequent).repartition("token")
    hubs = dealt.groupBy("token").agg(F.min(F.expr(_LEADS)).alias("hub"), F.min("node").alias("a"), F.max("node").alias("b"))
    hubs = hubs.where("a < b").select("token", *_hub("hub"))
    entries = dealt.join(hubs, "token")
    entries = cut(entries.distinct() if again else entries)
    texts = _texts(first_docs, text, cut(entries.select("node").distinct()))
    texts = cut(texts.dropDuplicates(["node"]) if again else texts)
    pairs = cut(entries.where("node <> hub").where(_WITH_HUB).select("hub", "node").distinct())
    live = entries.where("node <> hub").select("token", "node", "n", "rest")
    tested, links = pairs, cut(compared(pairs, texts))
    groups = _groups(links)
    for _ in range(HUB_ROUNDS):
        pairs, live = _hub_round(live, groups, tested)
        if pairs.isEmpty():
            continue
        tested = tested.unionByName(pairs)
        new = cut(compared(pairs, texts))
        if not new.isEmpty():
            links = links.unionByName(new)
            groups = _groups(links)
    crowds = cut(_crowds(live, groups))
    new = cut(queried(crowds, texts))
    if not new.isEmpty():
        links = links.unionByName(new)
        groups = _groups(links)
    return named.join(groups, "node", "left").select("id", "digest", "n", F.coalesce("label", "node").alias("label"))


def linked(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, the least id reachable by links."""
    placed = _placed(docs, doc_id, text)
    least = placed.where("label is not null").groupBy("label").agg(F.min("id").alias("least"))
    joined = placed.join(least, "label", "left")
    return joined.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold their component's kept text: the least id's, or
    where all ids are null the one of least digest; of rows that repeat an id and text, one.

    Rows are told apart by id and text, so that other texts of an id, null or not, are
    documents of their own and stay or go with their own components.
    """
    names = [fresh(c, docs.columns) for c in ("_id", "_digest")]
    placed = cut(_placed(docs.select(doc_id, text), doc_id, text))
    first = placed.where("label IS NOT NULL").groupBy("label").agg(F.min(F.expr(_LEAST)).alias("kept"))
    mine = F.col("kept").isNull() | (F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("digest") == F.col("kept.digest")))
    found = cut(placed.join(first, "label", "left").select(F.col("id").alias(names[0]), F.col("digest").alias(names[1]), mine.alias("stays")))
    gone = cut(found.where("NOT stays").select(*names).distinct())
    again = cut(found.where("stays").groupBy(*names).count().where(F.col("count") > 1).select(*names))
    same = F.col(doc_id).eqNullSafe(F.col(names[0])) & (_digest(text) == F.col(names[1]))
    out = docs.join(_listed(gone), same, "left_anti")
    if again.isEmpty():
        return out
    repeated = docs.join(_listed(again), same, "inner").dropDuplicates(names).drop(*names)
    return out.join(_listed(again), same, "left_anti").unionByName(repeated)


def _listed(ids: DataFrame) -> DataFrame:
    """Broadcast while the list is known to be short; otherwise joined by a shuffle."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
