"""Byte-level BPE encoding and decoding, long unsplit text by tree concatenation.

A text is split into pre-tokens, and each pre-token is encoded by itself.  One that is longer than LEAF bytes
is halved down to leaves, the halves are encoded apart, and at each join a growing window around it is encoded
again until its first and its last token are the ones that stood there: every neighbouring pair of tokens is
then one that the encoder itself produced, which makes the joined tokens the encoding of the whole.

Texts over PIECE characters are cut where pre-tokens end and their pieces are encoded in different tasks;
a pre-token over PIECE characters is cut anywhere, and its pieces are joined pairwise, level by level.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import save

#: Bytes of a pre-token that are encoded in one go.
LEAF = 256
#: Characters of a text that one task encodes in one go.
PIECE = 1 << 18
#: Encoded pre-tokens that a worker remembers.
MEMO = 1 << 19
#: Bytes of text (and about as many of ids) in one Arrow batch.
BATCH = 1 << 22

def split_pattern(letters: str, numbers: str, blanks: str) -> str:
    """The split pattern of this vocabulary family over three classes, given as what stands inside a set."""
    # Fixed value: the order and form of the alternatives.
    return (rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{blanks}{letters}{numbers}]+"
            rf"|[{blanks}]+(?![^{blanks}])|[{blanks}]+")


# Letters, numbers and blanks up to U+024F, for the plainer and faster engine.
_LATIN = re.compile(split_pattern(r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"))
_BEYOND = re.compile(r"[^\x00-\u024f]")
# Letters up to here are the same in all Unicode versions in use.
_OLD = regex.compile(r"[^\x00-\u0557]")
#: In a set that would else be empty; no text holds it.
NEVER = r"\uD800"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_chars() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Memo(dict):
    """Pre-token -> its ids as bytes of int32."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        ids = array("i", self.encode(word.encode())).tobytes()
        if len(word) <= LEAF:
            self[word] = ids
        return ids


class Vocabulary:
    """A byte-level BPE vocabulary file (JSON of the ``tokenizers`` library)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, chars = spec["model"], _byte_chars()
        if spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("a byte-level vocabulary without normaliser and prefix space is needed")
        self.path, vocab = path, model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.table = {i: t.encode() if t in self.special else bytes(chars[c] if c in chars else 63 for c in t) for t, i in vocab.items()}
        self.table |= {i: t.encode() for t, i in self.special.items()}
        self.first = [vocab[c] for c, _ in sorted(chars.items(), key=lambda x: x[1])]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        self.rank = {(vocab[a], vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.made = [vocab[a + b] for a, b in pairs]
        self.memo = _Memo(self.tree)
        tokens = [self.table.get(i, b"") for i in range(max(self.table) + 1)]
        self._raw, self._sizes = np.frombuffer(b"".join(tokens), np.uint8), np.array([len(t) for t in tokens], np.int64)
        self._starts = np.cumsum(self._sizes) - self._sizes
        self._pattern = regex.compile(split_pattern(r"\p{L}", r"\p{N}", r"\s"))
        self._library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._seen, self._fixes = set(), {(n, b): [] for n in "LN" for b in (True, False)}
        self._marks = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    # one pre-token ------------------------------------------------------------------------------------

    def merge(self, raw: bytes) -> list[int]:
        """Ids of a byte string taken as one pre-token: lowest merge first, leftmost of equals."""
        ids, rank, made = [self.first[b] for b in raw], self.rank, self.made
        n = len(ids)
        if n <= 64:
            none, get = len(made), rank.get
            ranks = [get(p, none) for p in zip(ids, ids[1:])]
            while ranks and (best := min(ranks)) < none:
                i = ranks.index(best)
                ids[i:i + 2] = [made[best]]
                del ranks[i]
                if i:
                    ranks[i - 1] = get((ids[i - 1], ids[i]), none)
                if i < len(ranks):
                    ranks[i] = get((ids[i], ids[i + 1]), none)
            return ids
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, p in enumerate(zip(ids, ids[1:])) if (r := rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j >= n or rank.get((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j], after[i] = made[r], None, after[j]
            if after[j] < n:
                before[after[j]] = i
                if (q := rank.get((ids[i], ids[after[j]]))) is not None:
                    heapq.heappush(heap, (q, i))
            if (b := before[i]) >= 0 and (q := rank.get((ids[b], ids[i]))) is not None:
                heapq.heappush(heap, (q, b))
        return [i for i in ids if i is not None]

    def tree(self, raw: bytes) -> list[int]:
        """Ids of one pre-token of any length: halves apart, then joined."""
        if len(raw) <= LEAF:
            return self.merge(raw)
        level = [self.merge(raw[i:i + LEAF]) for i in range(0, len(raw), LEAF)]
        while len(level) > 1:
            level = [self.join(*level[i:i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        return level[0]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two encoded neighbours as one pre-token: the window grows until both its sides agree."""
        if not left or not right:
            return left + right
        k, bytes_of = 4, self.table
        while True:
            a, b = left[-k:], right[:k]
            new = self.merge(b"".join([bytes_of[i] for i in a + b]))
            if (k >= len(left) or new[0] == a[0]) and (k >= len(right) or new[-1] == b[-1]):
                return left[:-k] + new + right[k:]
            k *= 2

    # texts --------------------------------------------------------------------------------------------

    def pattern(self, text: str):
        """The split pattern with the letters and numbers that the library itself takes for such: newer versions
        of Unicode have more of them, so every new character is shown to the library once."""
        if not _BEYOND.search(text):
            return _LATIN
        if not _OLD.search(text) or not (new := set(text) - self._seen):
            return self._pattern
        self._seen |= new
        for (name, lead, known), c in product((("L", "a", r"\p{L}"), ("N", "1", r"\p{N}")), new):
            inside = self._library(lead + c + "!")[0][1] == (0, 2)  # a member joins the run of its lead
            if inside != bool(regex.match(known, c)):
                self._fixes[name, inside].append(f"\\U{ord(c):08x}")
        if any(self._fixes.values()):
            sets = {n: f"[[{k}--[{''.join(self._fixes[n, False]) or NEVER}]]||[{''.join(self._fixes[n, True]) or NEVER}]]" for n, k in (("L", r"\p{L}"), ("N", r"\p{N}"))}
            self._pattern = regex.compile(split_pattern(sets["L"], sets["N"], r"\s"), regex.V1)
        return self._pattern

    def spans(self, text: str, at: int = 0, to: int | None = None):
        """(start, end, special id or None) of the pre-tokens of text[at:to]; both ends must be such ends."""
        to, find = len(text) if to is None else to, self.pattern(text).finditer
        for m in self._marks.finditer(text, at, to) if self._marks else ():
            for w in find(text, at, m.start()):
                yield w.start(), w.end(), None
            yield m.start(), m.end(), self.special[m[0]]
            at = m.end()
        for w in find(text, at, to):
            yield w.start(), w.end(), None

    def encode(self, text: str) -> bytes:
        """Ids of a text as bytes of int32."""
        words = self.pattern(text).findall
        if not self._marks or not self._marks.search(text):
            return b"".join(map(self.memo.__getitem__, words(text)))
        return b"".join(np.int32(self.special[part]).tobytes() if i % 2 else b"".join(map(self.memo.__getitem__, words(part)))
                        for i, part in enumerate(self._marks.split(text)))

    def decode(self, ids) -> str:
        """Text of ids, those of special tokens included; unknown ids are nothing, broken UTF-8 is U+FFFD."""
        ids = np.asarray(ids, np.int64)
        return self.bytes_of(ids[(ids >= 0) & (ids < len(self._sizes))]).decode("utf-8", "replace")

    def bytes_of(self, ids: np.ndarray) -> bytes:
        sizes = self._sizes[ids]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        return self._raw[np.arange(ends[-1]) + np.repeat(self._starts[ids] - ends + sizes, sizes)].tobytes()

    def pieces(self, text: str, size: int):
        """(run, node, text) parts of a long text: parts of one run are one pre-token cut anywhere."""
        at, run, n = 0, 0, len(text)
        gap = regex.compile(r"(?r)(?<=\S)(?=[\t\n\r ])")
        while at < n:
            if n - at <= size:
                yield run, 0, text[at:]
                return
            m = gap.search(text, at + 1, at + size)  # a blank after a non-blank starts a pre-token
            if m and m.start() > at:
                yield run, 0, text[at:m.start()]
                at, run = m.start(), run + 1
                continue
            start = at
            for a, b, special in self.spans(text, at):
                if b - start <= size:
                    at = b
                    continue
                if at > start:  # what fits before this pre-token
                    yield run, 0, text[start:at]
                    run += 1
                if b - a > size:
                    for node, i in enumerate([a] if special is not None else range(a, b, size)):
                        yield run, node, text[i:b if special is not None else min(i + size, b)]
                    at, run = b, run + 1
                break
            else:
                yield run, 0, text[start:]
                return


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once in a Python worker."""
    return Vocabulary(path)


def _lists(parts: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)])
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.frombuffer(b"".join(parts), np.int32))).cast(pa.list_(pa.int32()))


def _sliced(batch: pa.RecordBatch, col: int):
    """Slices of a batch with about BATCH bytes in the column; one longer value is taken alone."""
    at, n = 0, batch.num_rows
    while at < n:
        to, size = at, 0
        while to < n and (to == at or size < BATCH):
            v = batch.column(col)[to]
            size += len(v) * 4 if pa.types.is_list(batch.column(col).type) else v.as_buffer().size if v.is_valid else 0
            to += 1
        yield batch.slice(at, to - at)
        at = to


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, piece: int = PIECE) -> DataFrame:
    """(doc_id, ids array<int>) of every row: the ids the ``tokenizers`` library gives without added special tokens.

    ``path`` is the vocabulary file, readable on every executor.  A special token's string in a text becomes its
    id.  Null and empty texts give an empty array; null and repeated ids and repeated texts each keep their row; an
    empty table gives no row.  Only the two named columns are read, so others cannot clash.  Texts of over ``piece``
    characters are told apart by their SHA-256 and encoded once each.
    """
    path = path or default_vocabulary()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for part in _sliced(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), _lists([vocab.encode(t) for t in part.column(1).to_pylist()])], ["doc_id", "ids"])

    short = rows.where(F.length("text") <= piece).mapInArrow(run, f"doc_id {id_type}, ids array<int>")
    longer = rows.where(F.length("text") > piece).select("doc_id", "text", F.sha2("text", 256).alias("key"))
    return short.union(longer.drop("text").join(_encode_long(longer.select("key", "text"), path, piece), "key", "left").select("doc_id", "ids"))


def _encode_long(texts: DataFrame, path: str, piece: int) -> DataFrame:
    """(key, ids) of every distinct long text, its pieces encoded in different tasks."""

    def cut(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for run, node, part in vocab.pieces(text.as_py(), piece):
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([run], pa.int64()), pa.array([node], pa.int64()), pa.array([part])],
                                                     ["key", "run", "node", "part"])

    def leaves(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for part in _sliced(batch, 3):
                chained = part.column(4).to_pylist()
                ids = [np.array(vocab.tree(t.encode()), np.int32).tobytes() if c else vocab.encode(t) for t, c in zip(part.column(3).to_pylist(), chained)]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], _lists(ids)], ["key", "run", "node", "ids"])

    def joined(pdf):
        pdf, vocab = pdf.sort_values("node"), vocabulary(path)
        ids = [list(map(int, x)) for x in pdf["ids"]]
        return pdf.iloc[:1].assign(node=pdf["node"] // 2, ids=[vocab.join(*ids) if len(ids) > 1 else ids[0]])[["key", "run", "node", "ids"]]

    parts = save(texts.mapInArrow(cut, "key string, run long, node long, part string").dropDuplicates(["key", "run", "node"]), "bpe-pieces")
    chains = parts.groupBy("key", "run").agg(F.max("node").alias("top")).where("top > 0")
    schema = "key string, run long, node long, ids array<int>"
    marked = parts.join(chains, ["key", "run"], "left").select("key", "run", "node", "part", F.col("top").isNotNull().alias("chained"))
    level = save(marked.mapInArrow(leaves, schema), "bpe-ids")
    top = parts.agg(F.max("node")).first()[0] or 0
    while top:  # one level of the tree in each turn: neighbours meet in one task, two at a time
        alone = level.join(chains.select("key", "run"), ["key", "run"], "left_anti")
        pairs = level.join(chains.select("key", "run"), ["key", "run"], "left_semi").withColumn("pair", F.shiftright("node", 1))
        level = save(alone.union(pairs.groupBy("key", "run", "pair").applyInPandas(joined, schema)), "bpe-ids")
        top >>= 1
    return level.groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("run", "ids"))), lambda x: x["ids"])).alias("ids"))


def decode(encoded: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(doc_id, ids, text): the text of every row's ids, special tokens included.

    A null array gives a null text, an empty one an empty text; unknown ids are left out, and bytes that are no
    UTF-8 become U+FFFD, as in the ``tokenizers`` library.
    """
    path = path or default_vocabulary()
    rows = encoded.select("doc_id", F.col(ids_col).alias("ids"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        vocab = vocabulary(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(
                    [vocab.decode(x.values.to_numpy()) if x.is_valid else None for x in part.column(1)], pa.string())], ["doc_id", "ids", "text"])

    return rows.mapInArrow(run, f"doc_id {id_type}, ids array<int>, text string")
