"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token there is one token that its encoding ends with.
Candidates are the tokens that are suffixes of the prefix; a suffix automaton of the
vocabulary reports them in one pass. A candidate is the right one if it can
stand beside the last token of the prefix before it, that is, if no merge ever
joins the two across their border. The back-pointers give the ids.

The compatible-pair test walks down the two spines of merges that touch the
border and looks for a merge of neighbours that would have come first. Tests are
remembered per worker, as are pre-tokens, both up to a fixed number.

Defined cases: null and empty texts have no ids and decode to the empty text.
Special strings inside a text become their id. Ids outside the vocabulary cannot
arise. Repeated rows each get a row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitfeat.llm.common import handing_back, whole
from pitfeat.llm.pretokens import splitter
from pitfeat.llm.suffix_automaton import SuffixAutomaton

#: pre-tokens and pairs that a worker remembers; beyond, it starts anew
MEMORY = 400_000
_NEVER = 1 << 30


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable bytes
    stand for themselves, the others for letters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    def __init__(self, path: str):
        self.splitter = splitter(path)
        spec = self.splitter.spec["model"]
        letters = _byte_letters()
        vocab, special = spec["vocab"], self.splitter.special
        self.bytes_of = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in special}
        self.bytes_of |= {i: t.encode() for t, i in special.items()}
        #: rank of the merge that makes a pair, and the merge that made a token
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(spec["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.rank[pair] = rank
            self.parts.setdefault(made, (rank, *pair))
        self.automaton = SuffixAutomaton(
            (self.bytes_of[i], i) for t, i in vocab.items() if t not in special and (len(t) == 1 or i in self.parts))
        self._pairs: dict[tuple[int, int], bool] = {}
        self._whole: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}

    def _spine(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """Pieces at the border as (piece, rank made at, rank it is merged at)."""
        out, ends = [], _NEVER
        while token in self.parts:
            rank = self.parts[token][0]
            out.append((token, rank, ends))
            token, ends = self.parts[token][side], rank
        return [*out, (token, -1, ends)]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the encoding of both tokens' bytes is these two tokens.

        Equal ranks merge from the left, which decides the ties.
        """
        key = (a, b)
        known = self._pairs.get(key)
        if known is None:
            right = self._spine(b, 1)
            known = not any(
                (rank := self.rank.get((x, y))) is not None
                and rank < x_ends and rank <= y_ends and x_made <= y_ends and y_made < x_ends
                for x, x_made, x_ends in self._spine(a, 2)
                for y, y_made, y_ends in right)
            if len(self._pairs) >= MEMORY:
                self._pairs.clear()
            self._pairs[key] = known
        return known

    def stands_alone(self, token: int) -> bool:
        """Whether the token's own bytes are encoded as that one token."""
        known = self._whole.get(token)
        if known is None:
            made = self.parts.get(token)
            known = made is None or (
                self._best(self.bytes_of[token], skip=token) is None)
            self._whole[token] = known
        return known

    def _best(self, data: bytes, skip: int | None = None) -> list[int] | None:
        """Last token of each prefix; ``skip`` may not be the whole."""
        n = len(data)
        last = [-1] * (n + 1)
        pairs, compatible = self._pairs.get, self.compatible
        tokens, length, up = self.automaton.token, self.automaton.length, self.automaton.up
        for at, state in enumerate(self.automaton.ends(data), 1):
            # tokens that end here, longest first
            while state:
                token, before = tokens[state], at - length[state]
                if before == 0:
                    fits = token != skip and self.stands_alone(token)
                else:
                    left = last[before]
                    fits = left >= 0 and pairs((left, token))
                    if fits is None:
                        fits = compatible(left, token)
                if fits:
                    last[at] = token
                    break
                state = up[state]
        return last if last[n] >= 0 else None

    def pretoken_ids(self, pretoken: str) -> list[int]:
        data = pretoken.encode()
        last = self._best(data)
        ids, at = [], len(data)
        while at:
            token = last[at]
            ids.append(token)
            at -= len(self.bytes_of[token])
        return ids[::-1]

    def packed(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        out, known = [], self._pieces
        for k, part in enumerate(self.splitter.sections(text)):
            if k % 2:
                out.append(struct.pack("<I", self.splitter.special[part]))
                continue
            for p in self.splitter.split(part):
                piece = known.get(p)
                if piece is None:
                    ids = self.pretoken_ids(p)
                    piece = struct.pack(f"<{len(ids)}I", *ids)
                    if len(known) >= MEMORY:
                        known.clear()
                    known[p] = piece
                out.append(piece)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        data = self.packed(text)
        return list(struct.unpack(f"<{len(data) // 4}I", data))

    def decode(self, ids) -> str:
        """Bytes of the ids; broken sequences become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array<int>), n_tokens and exact of every row.

    ``exact`` says that decoding the ids gives the text again.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        c = codec(path)
        for b in batches:
            ids, exact = [], []
            for t in b.column("_text"):
                text = t.as_py()
                data = c.packed(text)
                ids.append(np.frombuffer(data, np.int32))
                exact.append(c.decode(memoryview(data).cast("I")) == text)
            sizes = np.array([len(i) for i in ids], np.int64)
            ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), lists, pa.array(sizes), pa.array(exact, pa.bool_())],
                ["doc_id", "ids", "n_tokens", "exact"])

    return docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("_text")).mapInArrow(
        handing_back(run), f"doc_id {kind}, ids array<int>, n_tokens long, exact boolean")


def decode(rows: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids; null ids give the empty text."""
    kind = rows.schema[doc_id].dataType.simpleString()

    def run(batches):
        c = codec(path)
        for b in batches:
            texts = [c.decode(x or ()) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(
        run, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode in one pass over the rows, keeping digests only.

    doc_id, n_tokens, ids_sha256 (over little-endian unsigned 32-bit ids),
    decoded_sha256 (over the decoded text in UTF-8).
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        c = codec(path)
        for b in batches:
            n, ids, back = [], [], []
            for t in b.column("_text").to_pylist():
                data = c.packed(t)
                n.append(len(data) // 4)
                ids.append(hashlib.sha256(data).hexdigest())
                again = c.decode(memoryview(data).cast("I"))
                back.append(hashlib.sha256(again.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(doc_id).alias("doc_id"), whole(text).alias("_text")).mapInArrow(
        handing_back(run), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
