"""Personal data: patterns, and a character model that adds what they miss.

Patterns find emails, IPv4 addresses, card numbers and phone numbers.  A bidirectional
LSTM with CRF transitions (`tagger`) is trained in numpy from labelled spans: those the
patterns find in a bounded sample of the texts, and planted ones, with spellings the
patterns do not know and look-alikes that are none.  It reads every character of every
text in overlapping windows.  Each character takes its tag from the window in which it
lies farther from the border; runs of equal tags over the whole text are the spans, so
one that crosses windows is whole.  A span is added if it has the digits or signs of its
kind and touches no span of the patterns; those always stay.

Null and empty texts have no spans.  Rows are independent: repeated rows get equal
spans; an empty table gives an empty result (the model then has planted spans only).
Memory per task: one batch, and ``BATCH`` windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.columns import byte_column
from cadenza.llm.tagger import Tagger

KINDS = ("email", "ip", "card", "phone")
#: Texts whose stretches train the model, and characters of each.
SAMPLE_ROWS, SAMPLE_CHARS = 1_500, 1_200
ROUNDS = 300
WINDOW, OVERLAP, BATCH = 256, 32, 2_048

Span = tuple[int, int, int]  # start, end, kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """From every @ outward, which never rereads a long word."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done, 0
        else:
            # What precedes this @ can't be part of a later address.
            done = at + 1
        at = text.find("@", done)


def pattern_spans(text: str) -> list[Span]:
    """The base spans, by start, then kind."""
    spans = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                spans.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    spans.append((m.start(), m.end(), 3))
    spans.sort(key=lambda s: (s[0], s[2]))
    return spans


def _classes() -> tuple[np.ndarray, int]:
    """The character class of each byte that begins a character; 0 pads."""
    table = np.zeros(256, np.uint8)
    groups = ["0", "1", "23456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", " ", "\n\r\t\v\f"]
    groups += list("@.+-_%()[]:/=,")
    rest = len(groups) + 1
    table[:128] = rest
    for i, group in enumerate(groups, 1):
        table[[ord(c) for c in group]] = i
    table[128:] = rest + 1
    return table, rest + 2


CLASS, CLASSES = _classes()


def codes_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all characters of UTF-8 rows, and the rows' offsets in characters."""
    begins = (data & 0xC0) != 0x80
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(begins)])
    return CLASS[data[begins]], upto[offsets]


def window_starts(n: int) -> range:
    return range(0, max(1, n - OVERLAP), WINDOW - OVERLAP)


def model_spans(model: Tagger, data: np.ndarray, offsets: np.ndarray) -> dict[int, list[Span]]:
    """What the model marks, by row, before any check."""
    codes, at = codes_of(data, offsets)
    size = np.diff(at)
    counts = np.where(size > 0, np.maximum(1, -(-(size - OVERLAP) // (WINDOW - OVERLAP))), 0)
    row = np.repeat(np.arange(len(size)), counts)
    place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = place * (WINDOW - OVERLAP)
    length = np.minimum(size[row] - start, WINDOW)
    padded = np.concatenate([codes, np.zeros(WINDOW, np.uint8)])
    marks: dict[int, list[tuple[int, np.ndarray]]] = {}
    order = np.argsort(length, kind="stable")
    for first in range(0, len(order), BATCH):
        chosen = order[first : first + BATCH]
        steps = -(-int(length[chosen[-1]]) // 16) * 16
        begin = at[row[chosen]] + start[chosen]
        block = padded[np.minimum(begin[:, None] + np.arange(steps), len(padded) - 1)]
        block[np.arange(steps) >= length[chosen][:, None]] = 0
        live, tags = model.tags(np.ascontiguousarray(block.T).astype(np.intp))
        for column, window in enumerate(chosen[live]):
            r, s, n = int(row[window]), int(start[window]), int(length[window])
            own = slice(OVERLAP // 2 if s else 0, n if s + n == size[r] else n - OVERLAP // 2)
            marks.setdefault(r, []).append((s + own.start, tags[own, column]))
    return {r: _runs(sorted(parts, key=lambda p: p[0])) for r, parts in marks.items()}


def _runs(parts: list[tuple[int, np.ndarray]]) -> list[Span]:
    """Runs of equal tags over all windows of a text; stretches without marks lie between."""
    spans: list[Span] = []
    for begin, tags in parts:
        edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
        for a, b in zip(edges, edges[1:], strict=False):
            if tags[a]:
                span = begin + int(a), begin + int(b), int(tags[a]) - 1
                if spans and spans[-1][1] == span[0] and spans[-1][2] == span[2]:
                    span = spans.pop()[0], span[1], span[2]
                spans.append(span)
    return spans


_KEEP = re.compile(r"[0-9A-Za-z+(](?:.*[0-9A-Za-z])?", re.S)
_AT = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|[\[(] ?at ?[\])]) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]+)+$")
_GROUPS = re.compile(r"\+?\(?[0-9]{1,4}\)?(?:[ ./-]?\(?[0-9]{2,4}\)?){2,4}$")
_OCTETS = re.compile(r"[0-9]{1,3}(?: ?(?:\.|\[\.\]) ?[0-9]{1,3}){3}$")


def plausible(text: str, kind: int) -> bool:
    """An exact check of a span that the model adds."""
    digits = "".join(_DIGIT.findall(text))
    if kind == 0:
        return bool(_AT.match(text))
    if kind == 1:
        return bool(_OCTETS.match(text)) and all(int(p) <= 255 for p in re.findall("[0-9]+", text))
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search("[^0-9 ./_-]", text)
    return 9 <= len(digits) <= 15 and bool(_GROUPS.match(text)) and bool(re.search("[ ()/.-]", text)) and not _OCTETS.match(text)


def reconciled(text: str, base: list[Span], marked: list[Span]) -> list[Span]:
    """The base spans and the model's that pass, by start, then kind."""
    added = []
    for start, end, kind in marked:
        core = _KEEP.search(text, start, end)
        if core is None:
            continue
        a, b = core.span()
        if plausible(text[a:b], kind) and all(b <= s or e <= a for s, e, _ in base):
            added.append((a, b, kind))
    return sorted(base + added, key=lambda s: (s[0], s[2])) if added else base


# --- training ---------------------------------------------------------------------


def _digits(rng, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def _planted(rng) -> tuple[str, int]:
    """A span of one of the kinds (its tag), or a look-alike (0)."""
    kind = int(rng.integers(0, 6))
    letters = "abcdefghijklmnopqrstuvwxyz"
    word = lambda n: "".join(letters[i] for i in rng.integers(0, 26, n))
    if kind == 0:
        name, host = word(rng.integers(3, 9)), word(rng.integers(3, 8))
        name += ["", f".{_digits(rng, 2)}", f"_{word(3)}", _digits(rng, 1)][rng.integers(0, 4)]
        at, dot = [("@", "."), ("@", "."), ("@", "."), (" @ ", "."), (" [at] ", " [dot] "), ("(at)", "(dot)")][rng.integers(0, 6)]
        return f"{name}{at}{host}{dot}{['com', 'org', 'net', 'example'][rng.integers(0, 4)]}", 1
    if kind == 1:
        dot = [".", ".", ".", "[.]", " . "][rng.integers(0, 5)]
        return dot.join(str(n) for n in rng.integers(0, 256, 4)), 2
    if kind == 2:
        body = _digits(rng, 15)
        body += next(d for d in "0123456789" if luhn(body + d))
        gap = ["", " ", "-", ".", "/"][rng.integers(0, 5)]
        return gap.join(body[i : i + 4] for i in range(0, 16, 4)), 3
    if kind == 3:
        a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
        forms = [f"+1 ({a}) {b}-{c}", f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{_digits(rng, 2)} {a} {b} {c}", f"00{_digits(rng, 2)} {a} {b} {c}"]
        return forms[rng.integers(0, len(forms))], 4
    hexes = "".join("0123456789abcdef"[i] for i in rng.integers(0, 16, 40))
    alike = [hexes, f"token = {hexes[:30]}", f"password={hexes[:18]}", "AKIA" + word(16).upper(), f"20{_digits(rng, 2)}-0{_digits(rng, 1)}-1{_digits(rng, 1)}",
             f"{_digits(rng, 2)}.{_digits(rng, 1)}", f"version {_digits(rng, 1)}.{_digits(rng, 1)}.{_digits(rng, 1)}", _digits(rng, 4), f"BY-NC {_digits(rng, 1)}.0",
             f"{_digits(rng, 1)},{_digits(rng, 3)},{_digits(rng, 3)}", f"{word(4)} at {word(5)}", f"({word(3)})", _digits(rng, 8), f"{_digits(rng, 2)}:{_digits(rng, 2)}:{_digits(rng, 2)}"]
    return alike[rng.integers(0, len(alike))], 0


TRAIN_WINDOW = 80


def examples(texts: list[str], seed: int = 5, many: int = 4_000) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags (time, example) of windows of the texts, most with something planted."""
    rng = np.random.default_rng(seed)
    texts = [t for t in texts if t] or ["and so it was said, once more."]
    codes, tags = np.zeros((TRAIN_WINDOW, many), np.intp), np.zeros((TRAIN_WINDOW, many), np.int8)
    for i in range(many):
        text = texts[i % len(texts)]
        base = [s for s in pattern_spans(text)]
        if base and i % 2:
            start, _, _ = base[int(rng.integers(0, len(base)))]
            begin = max(0, start - int(rng.integers(0, 40)))
        else:
            begin = int(rng.integers(0, max(1, len(text) - TRAIN_WINDOW)))
        piece = text[begin : begin + TRAIN_WINDOW]
        marks = np.zeros(len(piece), np.int8)
        for s, e, kind in base:
            marks[max(0, s - begin) : max(0, e - begin)] = kind + 1
        if i % 4 != 3 and not marks.any():
            phrase, tag = _planted(rng)
            where = int(rng.integers(0, max(1, len(piece) - len(phrase))))
            space = [i for i, c in enumerate(piece[: where + 1]) if c == " "]
            where = space[-1] + 1 if space else 0
            piece = piece[:where] + phrase + " " + piece[where:]
            marks = np.concatenate([marks[:where], np.full(len(phrase), tag, np.int8), marks[where : where + 1] * 0, marks[where:]])
        data = np.frombuffer(piece.encode(), np.uint8)
        own, _ = codes_of(data, np.array([0, len(data)]))
        n = min(len(own), TRAIN_WINDOW)
        codes[:n, i], tags[:n, i] = own[:n], marks[:n]
    return codes, tags


def trained(docs: DataFrame, text: str = "text") -> Tagger:
    """A model from stretches of the ``SAMPLE_ROWS`` different texts of least hash.

    A hash limit drawn from the number of rows leaves some four times as many before any
    are sorted, so that no task sees more however many tasks there are.
    """
    texts = docs.where(F.col(text).isNotNull())
    share = 4 * SAMPLE_ROWS / max(1, texts.count())
    key = F.xxhash64(text)
    stretch = F.substring(F.col(text), F.pmod(key, F.greatest(F.lit(1), F.length(text) - SAMPLE_CHARS)).cast("int") + 1, F.lit(SAMPLE_CHARS))
    rows = texts.select(key.alias("k"), stretch.alias("t"))
    if share < 1:
        rows = rows.where(F.col("k") < F.lit(int(share * (1 << 64)) - (1 << 63)))
    rows = rows.dropDuplicates(["k"]).orderBy("k", "t").limit(SAMPLE_ROWS).toArrow()
    model = Tagger(CLASSES, len(KINDS) + 1)
    model.fit(*examples(rows.column("t").to_pylist()), rounds=ROUNDS)
    return model


# --- queries ----------------------------------------------------------------------


def span_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def _found(model: Tagger, column: pa.Array) -> Iterator[tuple[str, list[Span], list[Span]]]:
    """Text, base spans and all spans of each row."""
    step = 512
    for first in range(0, len(column), step):
        part = column.slice(first, step)
        marked = model_spans(model, *byte_column(part))
        for i, text in enumerate(part.to_pylist()):
            text = text or ""
            base = pattern_spans(text) if text else []
            yield text, base, reconciled(text, base, marked[i]) if i in marked else base


def find_spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", model: Tagger | None = None) -> DataFrame:
    """Per row: the id, counts of base spans by kind, their digest, and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model or trained(docs, text))

    def run(batches):
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            digests, spans = [], []
            for _, base, every in _found(shared.value, batch.column(1)):
                for kind, out in enumerate(counts):
                    out.append(sum(k == kind for _, _, k in base))
                digests.append(hashlib.sha256(span_text(base).encode()).hexdigest())
                spans.append(span_text(every))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    cases = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    schema = f"id {cases.schema['id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    return cases.mapInArrow(run, schema).withColumnRenamed("id", doc_id)


def redacted(docs: DataFrame, *, text: str = "text", model: Tagger | None = None) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in angle brackets."""
    shared = docs.sparkSession.sparkContext.broadcast(model or trained(docs, text))

    def run(batches):
        for batch in batches:
            where = batch.schema.names.index(text)
            out = []
            nulls = batch.column(where).is_null().to_pylist()
            for (body, _, spans), null in zip(_found(shared.value, batch.column(where)), nulls, strict=True):
                done, parts = 0, []
                for start, end, kind in spans:
                    if end > done:
                        parts.append(body[done : max(start, done)] + f"<{KINDS[kind]}>" if start >= done else "")
                        done = end
                out.append(None if null else "".join(parts) + body[done:] if parts else body)
            yield batch.set_column(where, batch.schema.field(where), pa.array(out, pa.string()))

    return docs.mapInArrow(run, docs.schema)
