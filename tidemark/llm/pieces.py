"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The normaliser (a space becomes the word mark, one mark in front), the pieces
and the byte fallback are compiled to one machine: a trie whose accepting states
emit a piece at a weight, and an arc for every other character that emits its
UTF-8 bytes.  A text is composed with it by following the trie from every
reachable place, and its encoding is the shortest path in the tropical semiring
(least sum of weights, ties to the longer last piece).

Weights are negative log probabilities under Zipf's law, from the pieces' ranks
in the model: the model file has merge ranks, not probabilities.  No piece has a
word mark after anything but marks, so the shortest path of a text is that of its
words one after the other, each with all the spaces before it, and each distinct
word with its spaces is composed once.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tidemark.llm.common import batch_of, id_text, slices
from tidemark.llm.ragged import Words as _Words, gather

MARK = "▁"
#: A space that goes on with the next word; no byte of UTF-8.
_MORE = b"\xff"
_RUN = re.compile(rb"^ +|(?<= ) +")


class Words(_Words):
    """Words with the spaces before them, all but the one that they are cut at."""

    def array(self, texts: list[bytes]) -> pa.Array:
        return pa.array(texts, type=pa.binary())

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return super().texts([_RUN.sub(lambda m: _MORE * len(m[0]), t) if t[:1] == b" " or b"  " in t else t
                              for t in texts])


class Transducer:
    """Pieces, byte fallback and normaliser of a SentencePiece model file."""

    def __init__(self, model: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.vocab_size()
        used = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
                and (sp.get_score(i) > -1e6 or not sp.id_to_piece(i).strip(MARK))]
        used.sort(key=lambda i: (-sp.get_score(i), i))
        scale = math.log(sum(1 / r for r in range(1, len(used) + 2)))
        # state: (arcs, piece or -1, weight)
        self.root: list = [{}, -1, 0.0]
        for rank, i in enumerate(used):
            piece = sp.id_to_piece(i)
            if MARK in piece.lstrip(MARK) or MARK in piece[1:] and piece.strip(MARK):
                raise ValueError(f"piece {i} spans words")
            state = self.root
            for c in piece:
                state = state[0].setdefault(c, [{}, -1, 0.0])
            state[1:] = [i, math.log(rank + 1) + scale]
        #: A byte costs more than any piece, so it is used where no piece fits.
        self.byte_weight = math.log(len(used) + 1) + scale + 1.0
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.first_byte = min(self.bytes)
        surface = [b""] * n
        for i in used:
            surface[i] = sp.id_to_piece(i).replace(MARK, " ").encode()
        for b, i in enumerate(self.bytes):
            surface[i] = bytes([b])
        self.surface = np.frombuffer(b"".join(surface), dtype=np.uint8)
        self.length = np.array([len(s) for s in surface], dtype=np.int64)
        self.begin = np.cumsum(self.length) - self.length

    def path(self, chars: str, marks: int) -> list[int]:
        """Shortest path over ``chars``, of which the first ``marks`` are word marks
        and any further U+2581 is the text's own."""
        n = len(chars)
        cost = [math.inf] * (n + 1)
        back: list = [None] * (n + 1)
        cost[0] = 0.0
        root = self.root[0]
        for i in range(n):
            here = cost[i]
            c = chars[i]
            raw = c.encode("utf-8", "surrogatepass")
            if not (c == MARK and i < marks):
                total = here + self.byte_weight * len(raw)
                if total < cost[i + 1]:
                    cost[i + 1], back[i + 1] = total, (i, -1)
                if c == MARK:
                    continue
            arcs, j = root, i
            while j < n and (state := arcs.get(chars[j])) is not None:
                if chars[j] == MARK and j >= marks:
                    break
                j += 1
                arcs = state[0]
                if state[1] >= 0 and here + state[2] < cost[j]:
                    cost[j], back[j] = here + state[2], (i, state[1])
        out: list[int] = []
        j = n
        while j:
            i, piece = back[j]
            if piece < 0:
                out += [self.bytes[b] for b in reversed(chars[i].encode("utf-8", "surrogatepass"))]
            else:
                out.append(piece)
            j = i
        return out[::-1]

    def words(self, words: list[bytes]) -> list[list[int]]:
        """A word that begins with a line break goes on in the same word; any other has its
        mark; both have one more for each space kept with them."""
        out = []
        for w in words:
            rest = w.lstrip(_MORE)
            marks = len(w) - len(rest) + (rest[:1] != b"\n")
            out.append(self.path(MARK * marks + rest.decode(), marks))
        return out

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """The texts of consecutive runs of ``n`` ids."""
        size = self.length[ids]
        data = gather(self.surface, self.begin[ids], size).tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
        return [data[a + 1:z] if z > a else b"" for a, z in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, decoded`` for each row: the whole text's piece ids, and the text
    decoded from them again, as UTF-8.

    Decoding gives back every text exactly.  Null text is empty and has no ids.
    Every row is on its own, whatever its id; an empty table gives an empty
    result; other columns are ignored.  ``model`` is a path that every executor has.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.binary())])

    def run(batches):
        machine = Transducer(model)
        known = Words(machine.words)
        for rows, texts in slices(batches):
            ids, n = known.texts([t.replace(b"\n", b" \n") for t in texts])
            if b"" in texts:  # an empty text is no word at all
                empty = np.array([not t for t in texts])
                keep = np.repeat(~empty, n)
                ids, n = ids[keep], np.where(empty, 0, n)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), ids)
            yield batch_of(schema, rows.column("doc_id"), lists, machine.decode(ids, n))

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
