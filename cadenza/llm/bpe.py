"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

Encoding.  A merge of a pair is decided by what lies right of it only through merges of
higher priority that reach across its right end.  `Merges.lookahead` follows those
chains through the merge list and gives the most symbols a decision can depend on.
With that many symbols seen beyond a token's end, no merge across the end can come any
more: the token is stable, is emitted, and the rest is encoded independently.  A run
of letters of any length so needs a buffer of fixed size.  Every piece goes through it;
one that does not fill the buffer is merged at once.  Ids of short pieces are kept in two
caches of bounded size: what the older one gave lately outlives it.

Decoding.  `Decoder` is fed ids one at a time and gives text as soon as bytes make up
whole characters; it holds at most three bytes.  `JoinedDecoder` gives the form that the
file itself names, tokens joined by spaces, and holds one bit.

Texts are normalized and split as the tokenizer's file says (NFC, white space to one
space, per-character lower case; contractions, runs of letters, single digits, runs of
other signs); special tokens in a text are found first.  Letters are those of the `regex`
module's Unicode tables; they hold some characters newer than other libraries know.  Null and empty texts have no
ids.  Rows are independent, so repeated rows give equal results and an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Symbols encoded at a time, beyond the lookahead.
CHUNK = 64
#: Pieces in the newer cache before it becomes the older one; both together some 100 MB.
CACHE = 200_000
#: Characters of a text normalized at a time, cut at a space.
STRETCH = 1 << 16
_NONE = 1 << 60


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Merges:
    """A merge list over token ids: ranks of pairs and the lookahead they need."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str):
        self.ids = vocabulary
        self.end = end
        #: Of two ids, 24 bits each: the priority.
        self.pairs: dict[int, int] = {}
        #: By priority: what the pair becomes.
        self.wholes: list[int] = []
        self.lookahead = self._measure(merges)

    def _measure(self, merges: list) -> int:
        """Ranks every pair and returns the longest reach to the right.

        reach[x]: the most symbols to the right of a token that ends in x which can
        still decide whether something merges across its end, by the merges so far.
        Merges come in order of priority, so chains only lead to merges seen before.
        """
        size: dict[int, int] = {}
        spine: dict[int, tuple[int, ...]] = {}  # a token and what it ends in, down to one symbol
        reach: dict[int, int] = {}
        for rank, merge in enumerate(merges):
            left, right = merge if isinstance(merge, list | tuple) else merge.split(" ")
            u, v, whole = self.ids[left], self.ids[right], self.ids[left + right]
            self.pairs.setdefault(u << 24 | v, rank)
            self.wholes.append(whole)
            beyond = max(reach.get(x, 0) for x in spine.get(v, (v,)))
            reach[u] = max(reach.get(u, 0), size.get(v, 1) + beyond)
            size[whole] = max(size.get(whole, 0), size.get(u, 1) + size.get(v, 1))
            spine[whole] = tuple(dict.fromkeys((whole, *spine.get(whole, ()), *spine.get(v, (v,)))))
        longest = max(reach.values(), default=0)
        return longest + max(size.values(), default=1)

    def apply(self, ids: list[int]) -> list[int]:
        """Merges by priority, leftmost first among equals."""
        get, wholes = self.pairs.get, self.wholes
        waiting = [get(u << 24 | v, _NONE) for u, v in pairwise(ids)]
        left = len(waiting)
        while left:
            best = min(waiting)
            if best == _NONE:
                break
            i = waiting.index(best)
            ids[i] = whole = wholes[best]
            del ids[i + 1], waiting[i]
            left -= 1
            if i:
                waiting[i - 1] = get(ids[i - 1] << 24 | whole, _NONE)
            if i < left:
                waiting[i] = get(whole << 24 | ids[i + 1], _NONE)
        return ids

    def run(self, symbols: list[int], length: dict[int, int]) -> list[int]:
        """Ids of a run of symbols; a short one never fills the buffer."""
        if len(symbols) < CHUNK + 2 * self.lookahead:
            return self.apply(symbols)
        return list(self.stream(iter(symbols), length))

    def stream(self, symbols: Iterator[int], length: dict[int, int]) -> Iterator[int]:
        """Ids of a run of symbols of any length, in memory of CHUNK + lookahead symbols."""
        buffer: list[int] = []
        for symbol in symbols:
            buffer.append(symbol)
            if len(buffer) < CHUNK + 2 * self.lookahead:
                continue
            tokens, at = self.apply(buffer[:]), 0
            for token in tokens:
                if at + length[token] + self.lookahead > len(buffer):
                    break
                at += length[token]
                yield token
            buffer = buffer[at:]
        yield from self.apply(buffer)


#: Ids of a piece.  The garbage collector need not follow a tuple of numbers.
Piece = tuple[int, ...]


class WordBpe:
    """The tokenizer of a file: splits texts, encodes pieces, decodes ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.merges = Merges(model["vocab"], model["merges"], self.end)
        self.tokens = {i: t for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # [\p{L}]+ and \p{L}+ are the same; the set is slower.
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"[\p{L}]+", r"\p{L}+"))
        self.around = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.signs = byte_signs()
        self.inner = [self.merges.ids.get(s) for s in self.signs]
        self.last = [self.merges.ids.get(s + self.end) for s in self.signs]
        self.length = {i: len(t.removesuffix(self.end)) for i, t in self.tokens.items()}
        # Ids as text, by id.
        self.names = [str(i) for i in range(max(self.tokens) + 1)]
        self.cache: dict[str, Piece] = {}
        self.older: dict[str, Piece] = {}

    def piece(self, text: str) -> Piece:
        """Encodes a piece that is not in the newer cache."""
        found = self.older.get(text)
        if found is None:
            data = text.encode()
            symbols = [*map(self.inner.__getitem__, data)]
            symbols[-1] = self.last[data[-1]]
            if None in symbols:
                symbols = [s for s in symbols if s is not None]
            found = tuple(self.merges.run(symbols, self.length))
        if len(text) <= CHUNK:
            if len(self.cache) >= CACHE:
                self.older, self.cache = self.cache, {}
            self.cache[text] = found
        return found

    def stretches(self, text: str) -> Iterator[str]:
        """The text in parts of about STRETCH characters, each ending before a space."""
        at = 0
        while len(text) - at > STRETCH:
            cut = text.find(" ", at + STRETCH)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:] if at else text

    def normal(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        # Character by character: a final sigma keeps its usual form.
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def encode(self, text: str | None) -> Iterator[int]:
        for ids in self.parts(text):
            yield from ids

    def parts(self, text: str | None) -> Iterator[list[int]]:
        """The ids of one stretch of the text after another."""
        if not text:
            return
        for between in self.around.split(text) if "<|" in text else (text,):
            if between in self.special:
                yield [self.special[between]]
                continue
            for stretch in self.stretches(between):
                texts = self.pieces.findall(self.normal(stretch))
                # A piece may replace the cache; this one still holds what it held.
                get = self.cache.get
                yield [*chain.from_iterable([get(t) or self.piece(t) for t in texts])]

    def decode(self, ids) -> str:
        """As the file's tokenizer decodes: it has no decoder, so tokens are joined by a space."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


class Decoder:
    """Ids in, readable text out, one id at a time."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.byte_of = {s: b for b, s in enumerate(bpe.signs)}
        self.pending = b""

    def feed(self, i: int) -> str:
        token = self.bpe.tokens.get(i)
        if token is None:
            return ""
        if token in self.bpe.special:
            return self.finish() + token
        word_ends = bool(self.bpe.end) and token.endswith(self.bpe.end)
        data = self.pending + bytes(self.byte_of[s] for s in token.removesuffix(self.bpe.end))
        whole = len(data)
        for back in range(1, min(4, len(data) + 1)):  # an unfinished character waits
            lead = data[-back]
            if lead >= 0xC0:
                need = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                whole = len(data) - back if back < need else whole
                break
            if lead < 0x80:
                break
        self.pending = data[whole:]
        text = data[:whole].decode(errors="replace")
        return text + (self.finish() + " " if word_ends else "")

    def finish(self) -> str:
        left, self.pending = self.pending, b""
        return left.decode(errors="replace")


class JoinedDecoder:
    """Ids in, the file's decoded form out: it has no decoder, so tokens are joined by spaces.

    Its state is whether a token came before; ids may come in lists of any length, and ids
    without a token give nothing.
    """

    def __init__(self, bpe: WordBpe):
        self.token = bpe.tokens.get
        self.began = False

    def feed(self, ids: Iterable[int]) -> str:
        text = " ".join(filter(None, map(self.token, ids)))
        if not text:
            return ""
        lead, self.began = " " if self.began else "", True
        return lead + text


_LOADED: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """The file's tokenizer, read once per process."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file on this machine."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_column(df: DataFrame, *, doc_id: str, text: str = "text", name: str = "word_bpe_49k.json") -> DataFrame:
    """Per row: the id and ``ids``, all ids of the text."""

    def run(batches):
        bpe = tokenizer(tokenizer_path(name))
        for batch in batches:
            ids = pa.array([list(bpe.encode(t)) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    cases = df.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    kind = cases.schema["id"].dataType.simpleString()
    return cases.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", doc_id)


def round_trip(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", name: str = "word_bpe_49k.json") -> DataFrame:
    """Per row: the id, n_tokens, and digests of the ids and of what they decode to.

    Both digests are fed stretch by stretch, the second one with what an incremental
    decoder makes of the emitted ids; neither ids nor decoded text of a document are
    ever held whole.
    """

    def run(batches):
        bpe = tokenizer(tokenizer_path(name))
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            for body in batch.column(1).to_pylist():
                n, ids, back, lead, decoder = 0, hashlib.sha256(), hashlib.sha256(), "", JoinedDecoder(bpe)
                for emitted in bpe.parts(body):
                    if emitted:
                        n += len(emitted)
                        ids.update((lead + " ".join(map(bpe.names.__getitem__, emitted))).encode())
                        back.update(decoder.feed(emitted).encode())
                        lead = " "
                counts.append(n)
                ids_digest.append(ids.hexdigest())
                text_digest.append(back.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    cases = df.select(F.col(doc_id).alias("id"), F.col(text).alias("body"))
    kind = cases.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return cases.mapInArrow(run, schema).withColumnRenamed("id", doc_id)
