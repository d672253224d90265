"""Substring dedup by repeated-phrase automata.

A window is ``SIZE`` words in a row of one document; a word goes if a window over it
also starts in a document of smaller id.  Anchors bring the surroundings of possible
repeats to one task per anchor hash (`repeats`).  There recurring passages are confirmed
by window hashes, with the smallest document that has them; the passages' words, as that
document has them, are compiled into an Aho-Corasick automaton for the task's block of
hashes; and the segments of all documents are streamed through it.  A word goes only
where the automaton finds a passage word for word.

Null ids count as larger than all others.  Null, empty and short texts keep all words.
Whole copies of a text are judged by the least id that has it.  An id with several
texts is compared with other ids only.  An empty table gives an empty result.
"""

from __future__ import annotations

from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm import repeats
from cadenza.llm.anchors import WordUnits
from cadenza.llm.columns import Words, byte_column, mixed, windows

SIZE = 50
#: Words of an anchor.
RUN = 10
#: Segments worked on at once.
BLOCK = 4_000


def _passages(block: list[tuple]):
    """Recurring passages of a block: (text id, first, end, passage as a tuple of words' places)."""
    data, offsets = byte_column(pa.array([r[5] for r in block], pa.binary()))
    words = Words(data, offsets)
    hashed = windows(words.hashes(), SIZE)
    ids = np.array([r[1] for r in block], np.int64)
    lead = np.array([r[4] for r in block], np.int64)
    key = np.array([r[0] for r in block], np.int64)
    first, end = words.first_word[:-1], words.first_word[1:]
    count = np.maximum(end - first - SIZE + 1, 0)
    row = np.repeat(np.arange(len(block)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    # Equal windows of one hash stand at equal distances from the anchor.
    name = mixed(hashed[first[row] + start] ^ mixed(key[row].view(np.uint64)) + (start - lead[row]).astype(np.uint64))
    order = np.lexsort((ids[row], name))
    begins = np.ones(len(order), bool)
    begins[1:] = name[order][1:] != name[order][:-1]
    source = order[np.flatnonzero(begins)[np.cumsum(begins) - 1]] if len(order) else order
    owner = np.empty(len(row), np.int64)
    owner[order] = row[source]
    return words, row, start, owner, ids, first


def _signs(words: Words) -> str:
    """All words of a block as one sign each; equal signs are equal words."""
    _, first, number = np.unique(words.hashes(), return_index=True, return_inverse=True)
    if not words.same_as(first[number]):  # two words of one hash
        names: dict[bytes, int] = {}
        spelled = (words.data[a:b].tobytes() for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True))
        number = np.array([names.setdefault(w, len(names)) for w in spelled])
    signs = number.astype("<u4") + np.uint32(1)
    signs[signs >= 0xD800] += np.uint32(0x800)
    return signs.tobytes().decode("utf-32-le")


def block_spans(block: list[tuple]) -> list[tuple[int, int, int]]:
    """(text id, first word, end) of what repeats in a document of larger id."""
    words, row, start, owner, ids, first = _passages(block)
    again = np.flatnonzero(ids[owner] < ids[row])
    if not len(again):
        return []
    signs = _signs(words)
    # Runs of windows of one segment with one source are one passage.
    breaks = np.ones(len(again), bool)
    breaks[1:] = (row[again][1:] != row[again][:-1]) | (owner[again][1:] != owner[again][:-1]) | (start[again][1:] != start[again][:-1] + 1)
    at = np.flatnonzero(breaks)
    stop = np.append(at[1:], len(again)) - 1
    lead = np.array([r[4] for r in block], np.int64)
    mine, other = row[again[at]], owner[again[at]]
    low = first[other] + start[again[at]] + lead[other] - lead[mine]
    high = low + start[again[stop]] - start[again[at]] + SIZE
    automaton = ahocorasick.Automaton()
    least: dict[str, int] = {}
    for a, b, doc in zip(low.tolist(), high.tolist(), ids[other].tolist(), strict=True):
        passage = signs[a:b]
        if doc < least.get(passage, repeats.LAST + 1):
            least[passage] = doc
    for passage, doc in least.items():
        automaton.add_word(passage, (len(passage), doc))
    automaton.make_automaton()
    out = []
    for i in np.unique(mine).tolist():
        _, doc, tid, place, ahead, _ = block[i]
        begin = end = -1
        for last, (size, owner_) in automaton.iter(signs[words.first_word[i] : words.first_word[i + 1]]):
            if owner_ < doc:
                a, b = place - ahead + last + 1 - size, place - ahead + last + 1
                if a <= end:
                    begin, end = min(a, begin), b
                    continue
                if end >= 0:
                    out.append((tid, begin, end))
                begin, end = a, b
        if end >= 0:
            out.append((tid, begin, end))
    return out


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(tid, starts, ends) of the words that go, of prepared rows without whole copies."""
    units = partial(WordUnits, size=SIZE, run=RUN)
    keys = repeats.counted_anchors(rows, units, within=False)
    few, many = keys.where(F.col("times") <= repeats.CROWD), keys.where(F.col("times") > repeats.CROWD)

    def run(batches):
        for block in repeats.groups(batches, BLOCK):
            found = block_spans(block)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["tid", "start", "end"]
            )

    sent = repeats.segments(rows, few, units, SIZE - RUN, SIZE)
    spans = sent.mapInArrow(run, "tid long, start long, end long")
    if not many.isEmpty():
        spans = spans.unionByName(repeats.crowd_spans(rows, many, units, SIZE, within=False))
    return repeats.united(spans)


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, n_removed, kept_sha256 and ``kept``, the words that stay."""
    rows = repeats.prepared(docs, doc_id, text)
    copies = repeats.whole_copies(rows)
    spans = repeated_spans(repeats.representatives(rows, copies))
    found = repeats.marked(docs, doc_id, text, copies, spans)

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("id", "body", "first", "starts", "ends"))
            counts, gone, digests, texts = [], [], [], []
            for doc, body, first, starts, ends in zip(*columns, strict=True):
                words = _words(body)
                n = len(words)
                if first is not None and first < doc:
                    stay = [] if n >= SIZE else words
                else:
                    stay, at = [], 0
                    for a, b in zip(starts or (), ends or (), strict=True):
                        stay += words[at:a]
                        at = b
                    stay += words[at:]
                counts.append(n)
                gone.append(n - len(stay))
                digests.append(repeats.digest(stay, b" "))
                texts.append(b" ".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column("given"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["given", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    kind = found.schema["given"].dataType.simpleString()
    schema = f"given {kind}, n_words long, n_removed long, kept_sha256 string, kept string"
    return found.mapInArrow(run, schema).withColumnRenamed("given", doc_id)


def _words(body: str) -> list[bytes]:
    return body.encode().split()
