"""Byte-pair encoding by a deterministic automaton over tokens.

The automaton starts as one state with a loop for every byte. Each merge (u, v) -> x, in order, applies
a gadget: the state entered by u is copied without its arc v, u now enters the copy, and x is added
wherever u leaves, entering the state that v enters. What the automaton accepts after the last merge
are exactly the token sequences that the merges produce, and every prefix of a word has one of them,
so a word is encoded from left to right by table lookups. Decoding joins the labels of the arcs.

Out-arcs are not stored per state: a state keeps the state it was copied from and the label it lost,
and an arc is looked up along those records and remembered.

Texts are split into words by the tokenizer's pattern, and special tokens are found first, as the
tokenizers library does. Words repeat, so the encodings of up to twice ``CACHE`` words of 64
characters at most are kept per Python worker; others are encoded each time.

Letters that Unicode gained after the version the library was built with may be split differently.

Defined results: a null text counts as empty and has no tokens; every row gives one row; texts of any
length are encoded whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.registry import query
from tidemark.llm.text import whole

#: Fixed value: how byte-level tokenizers split a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE = 1 << 17


def byte_letters() -> dict[str, int]:
    """The letter by which vocabulary files write each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


#: Prefixes up to so many bytes are remembered.
KEPT = 64


class MergeAutomaton:
    """States are (token, time): what follows a token once the merges up to that time have been applied."""

    def __init__(self, singles: dict[bytes, int], merges: list[tuple[int, int, int]], labels: dict[int, bytes]):
        self.labels = labels
        self.born: dict[int, int] = {x: -1 for x in singles.values()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.lost: dict[tuple[int, int], int] = {}
        self.known: dict[int, bool] = {}
        self.paths: dict[bytes, int] = {}
        for time, (u, v, x) in enumerate(merges):
            self._gadget(time, u, v, x)
        self.end = len(merges)
        self.tree: dict[int, int] = {}  # node * 256 + byte -> node, over reversed labels
        self.token_at: list[int] = [-1]
        for x in self.born:
            node = 0
            for byte in reversed(labels[x]):
                node = self.tree.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[node] = x

    def _gadget(self, time: int, u: int, v: int, x: int) -> None:
        if u in self.born and v in self.born and x not in self.born and self._leaves(u, v, time - 1):
            self.lost[u, v] = time
            self.halves[x] = (u, v)
            self.born[x] = time

    def _leaves(self, state: int, label: int, time: int) -> bool:
        """Whether the state that token ``state`` enters at ``time`` has an arc ``label``."""
        while True:
            if self.lost.get((state, label), time + 1) <= time:
                return False
            a, b = self.born[state], self.born[label]
            if a < 0 and b < 0:
                return True
            if a == b:  # a token after itself: the state copied from has it where its first half could leave
                state, label, time = self.halves[state][1], self.halves[label][0], a - 1
            elif b > a:  # the label came later, wherever its first half could leave
                label, time = self.halves[label][0], b
            else:  # the state was that of the second half when the token came
                state, time = self.halves[state][1], a - 1

    def arc(self, state: int, label: int) -> bool:
        found = self._leaves(state, label, self.end)
        if len(self.known) >= 4 * CACHE:
            self.known.clear()
        self.known[state << 32 | label] = found
        return found

    def encode(self, word: bytes) -> list[int]:
        """The tokens of a word: the one accepted path, found from left to right.

        The last token of the path to a prefix depends on the prefix only, so it is remembered, up to
        2 * CACHE prefixes; words that begin alike share the work.
        """
        paths, known, step, token_at = self.paths, self.known, self.tree.get, self.token_at
        if len(paths) > 2 * CACHE:
            paths.clear()
        size = len(word)
        done = min(size, KEPT)
        while done and word[:done] not in paths:
            done -= 1
        last: dict[int, int] = {}
        for end in range(done + 1, size + 1):
            node = 0
            for start in range(end - 1, -1, -1):
                node = step(node << 8 | word[start])
                token = token_at[node]
                if token >= 0:
                    if not start:
                        break
                    before = last.get(start)
                    if before is None:
                        before = last[start] = paths[word[:start]]
                    arc = known.get(before << 32 | token)
                    if self.arc(before, token) if arc is None else arc:
                        break
            last[end] = token
            if end <= KEPT:
                paths[word[:end]] = token
        out, end = [], size
        while end:
            token = last.get(end)
            if token is None:
                token = paths[word[:end]]
            out.append(token)
            end -= len(self.labels[token])
        return out[::-1]


class Known(dict):
    """Encodings of the words met lately: two dicts of CACHE words at most, the older dropped when the newer is full."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = np.array(self.encode(word.encode()), "<u4").tobytes()
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Tokenizer:
    """Encodes and decodes texts with a byte-level vocabulary file's content."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        labels = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if all(c in letters for c in token)}
        merges = []
        for pair in spec["model"]["merges"]:
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            merges.append((vocab[a], vocab[b], vocab[a + b]))
        singles = {labels[i]: i for t, i in vocab.items() if i in labels and len(labels[i]) == 1}
        self.automaton = MergeAutomaton(singles, merges, labels)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = labels | {i: t.encode() for t, i in self.special.items()}
        listed = [self.labels.get(i, b"") for i in range(max(self.labels) + 1)]
        self.sizes = np.array([len(x) for x in listed])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(listed), np.uint8)
        self.words = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.known = Known(self.automaton.encode)

    def encode(self, text: str) -> np.ndarray:
        if self.specials is None or not self.specials.search(text):
            return self._plain(text)
        parts, at = [], 0
        for m in self.specials.finditer(text):
            parts += [self._plain(text[at:m.start()]), np.array([self.special[m[0]]], "<u4")]
            at = m.end()
        return np.concatenate([*parts, self._plain(text[at:])])

    def _plain(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.known.__getitem__, self.words.findall(text))), "<u4")

    def decode(self, ids) -> str:
        """The labels of the tokens, joined; ids without a token are left out."""
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.sizes))]
        out = []
        for i in range(0, len(ids), 1 << 16):
            part = ids[i:i + (1 << 16)]
            sizes = self.sizes[part]
            shift = self.starts[part] - (np.cumsum(sizes) - sizes)
            out.append(self.bytes[np.arange(int(sizes.sum())) + np.repeat(shift, sizes)].tobytes())
        return b"".join(out).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _compiled(content: bytes) -> Tokenizer:
    return Tokenizer(content)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file as read on the driver; a few MB, whatever the corpus."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), whole(docs[text_col]).alias("text"))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the token ids of the whole text, array<int>."""
    content = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _compiled(content.value)
        for rows in small(batches):
            ids = [tokenizer.encode(t.as_py()).astype(np.int32) for t in rows.column(1)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with the column ``text`` decoded from its token ids; null ids give an empty text."""
    content = vocabulary(tokens.sparkSession, path)

    @F.pandas_udf("string")
    def text(ids):
        labels = _compiled(content.value)
        return ids.map(lambda x: "" if x is None else labels.decode(x))
    return tokens.withColumn("text", text(tokens[ids_col]))


def small(batches: Iterator[pa.RecordBatch], limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes, so that long texts do not add up in memory."""
    for rows in batches:
        step = max(1, rows.num_rows * limit // max(rows.nbytes, limit))
        for i in range(0, rows.num_rows, step):
            yield rows.slice(i, step)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them, without moving the ids."""
    content = vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _compiled(content.value)
        for rows in small(batches):
            sizes, ids_hex, text_hex = [], [], []
            for t in rows.column(1):
                ids = tokenizer.encode(t.as_py())
                sizes.append(len(ids))
                ids_hex.append(hashlib.sha256(ids.tobytes()).hexdigest())
                text_hex.append(hashlib.sha256(tokenizer.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sizes, pa.int64()), pa.array(ids_hex, pa.string()),
                                              pa.array(text_hex, pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_checked(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``keep``, n_tokens, ids, and ``same``: whether the ids decode to the text."""
    content = vocabulary(docs.sparkSession, path)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), *[docs[c] for c in keep], whole(docs[text_col]).alias("_t"))
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _compiled(content.value)
        for batch in small(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            ids = [tokenizer.encode(t) for t in texts]
            same = [tokenizer.decode(x) == t for x, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(batch.num_columns - 1)], pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                names=[*names, "n_tokens", "ids", "same"])
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{types}, n_tokens long, ids array<int>, same boolean")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_bpe")
def bpe(documents: DataFrame) -> DataFrame:
    return round_trip(documents, default_vocabulary())
