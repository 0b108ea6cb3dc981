"""Tokenising documents and packing the ids into compressed, checksummed blocks.

A shard is one Parquet file of blocks (``rangecoder``), each of whole documents
in ascending id order; shards follow each other in id order too.  Any block can
be read on its own.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tidemark.llm.common import batch_of, id_text, slices, stage
from tidemark.llm.hashing import Rolling, U
from tidemark.llm.ragged import gather
from tidemark.llm.rangecoder import decode_block, encode_block

#: Ids after which a block is closed, at the end of the document.
BLOCK_IDS = 1 << 18
#: What stands for a null id in a block; it sorts first.
_NO_ID = -(1 << 63)

#: A-Z lower-cased, and the white space that certainly separates words made a space.
_LOWER = bytes(0x20 if c in b"\t\n\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SPACE, _LETTER, _DIGIT, _MARK, _GLUE = range(5)
#: What each byte of lower-cased text is; an apostrophe, control or byte beyond ASCII sticks to what it touches.
_KIND = np.array([_SPACE if c == 0x20 else _LETTER if 97 <= c <= 122 else _DIGIT if 48 <= c <= 57 else
                  _MARK if 0x20 < c < 0x7F and c != 0x27 else _GLUE for c in range(256)], dtype=np.uint8)
#: Whether a token certainly ends between two kinds.
_CUT = np.array([a != b and _GLUE not in (a, b) or a == b == _DIGIT or _SPACE in (a, b)
                 for a in range(5) for b in range(5)])
#: Lower-case letters that are the same in every form, as a word of them is one token to begin with.
_LETTERS = re.compile("[a-z\u00DF-\u00F6\u00F8-\u00FF]+")
_BLOCKS = pa.schema([("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("block", pa.binary())])


class HashedWords:
    """Remembers the ids of words by their 64-bit hashes, in a table of slots, so that all words of
    a slice are found at once; once there are more than ``limit``, forgets all but the first
    half of that, as frequent words come early."""

    def __init__(self, encode, limit: int = 1_500_000):
        self.encode, self.limit = encode, limit
        # by number; 0 is no word
        self.hash, self.first, self.n = np.zeros(1, dtype=U), np.zeros(1, dtype=np.int32), np.zeros(1, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.int32)
        self._keep(1)

    def _keep(self, size: int) -> None:
        """Forgets all words but those numbered below ``size``."""
        self.size, self.used = size, int(self.first[size - 1] + self.n[size - 1])
        self.hash, self.first, self.n = (c[:size].copy() for c in (self.hash, self.first, self.n))
        self.ids = self.ids[:self.used].copy()
        self._fill()

    def _fill(self) -> None:
        self.bits = max(16, (3 * self.size).bit_length())
        self.slot = np.zeros(1 << self.bits, dtype=np.int32)
        self._insert(np.arange(1, self.size, dtype=np.int32))

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U(64 - self.bits)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, 0 if it isn't known."""
        slot = self._slots(hashes)
        out = self.slot[slot]
        rest = np.flatnonzero((self.hash[out] != hashes) & (out != 0))
        while len(rest):
            slot[rest] = at = (slot[rest] + 1) & (len(self.slot) - 1)
            out[rest] = word = self.slot[at]
            rest = rest[(self.hash[word] != hashes[rest]) & (word != 0)]
        return out

    def _insert(self, words: np.ndarray) -> None:
        slot = self._slots(self.hash[words])
        while len(words):
            free = self.slot[slot] == 0
            self.slot[slot[free]] = words[free]
            on = self.slot[slot] != words  # of words that want one slot one gets it
            words, slot = words[on], (slot[on] + 1) & (len(self.slot) - 1)

    def _learn(self, hashes: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        size, used = self.size + len(hashes), self.used + len(ids)
        if size > len(self.hash):
            self.hash, self.first, self.n = (np.concatenate([c[:self.size], np.zeros(size - self.size + size // 4, dtype=c.dtype)])
                                             for c in (self.hash, self.first, self.n))
        if used > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.used], np.zeros(len(ids) + used // 4, dtype=np.int32)])
        new = slice(self.size, size)
        self.ids[self.used:used] = ids
        self.hash[new], self.first[new], self.n[new] = hashes, self.used + np.cumsum(n) - n, n
        old, self.size, self.used = self.size, size, used
        if 2 * size > len(self.slot):
            self._fill()
        else:
            self._insert(np.arange(old, size, dtype=np.int32))

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, cut into words where a token certainly ends, and how many each text has."""
        data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        kind = _KIND.take(data)
        cut = _CUT.take(kind[:-1] * np.uint8(5) + kind[1:])
        cut = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(data)]])
        word = np.flatnonzero(kind.take(cut[:-1]) != _SPACE)
        start, end = cut[word], cut[word + 1]
        hashes = Rolling(data).windows(start, end) | U(1)  # 0 is the hash of no word
        if self.size > self.limit:
            self._keep(1 + self.limit // 2)
        each = self._find(hashes)
        new = np.flatnonzero(each == 0)
        if len(new):
            distinct, where = np.unique(hashes[new], return_index=True)
            where = new[where]
            self._learn(distinct, *self.encode(data, kind, start[where], end[where]))
            each[new] = self._find(hashes[new])
        n = self.n[each].astype(np.int64)
        ids = gather(self.ids, self.first[each], n)
        firsts = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=firsts[1:])
        ends = np.concatenate([[0], np.cumsum(n)])
        return ids, np.diff(ends[np.searchsorted(start, firsts)])


class LowerCaseTokenizer:
    """Ids of whole texts, each distinct word encoded once.

    For tokenizers that lower-case, drop white space and never join what it
    separates, nor A-Z letters, digits and other ASCII characters but the
    apostrophe; a digit is always a token of its own.  If every word's last token
    says so, words go to the model many at a time and are told apart by it.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        #: Ids that end a word; the same model without what is no work for plain words.
        self.ends, self.plain = np.zeros(self.size, dtype=bool), Tokenizer(self.tokenizer.model)
        if suffix:
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.words = HashedWords(self._encode)

    def _encode(self, data: np.ndarray, kind: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Ids of the words at ``start`` to ``end``, and how many each has."""
        glue = np.flatnonzero(kind == _GLUE)
        simple = np.searchsorted(glue, start) == np.searchsorted(glue, end)
        odd = np.flatnonzero(~simple)
        whole = data.tobytes()
        texts = [whole[a:z].decode() for a, z in zip(start[odd].tolist(), end[odd].tolist(), strict=True)]
        letters = np.array([_LETTERS.fullmatch(t) is not None for t in texts], dtype=bool)
        simple[odd[letters]] = True
        n, parts = np.zeros(len(start), dtype=np.int64), []
        for which, encode in ((np.flatnonzero(simple), self._plain), (odd[~letters], self._whole)):
            if len(which):
                # each word with the byte after it, which becomes a space
                size = end[which] - start[which] + 1
                text = gather(data, start[which], size)
                text[np.cumsum(size) - 1] = 0x20
                ids, n[which] = encode(text.tobytes().decode(), size)
                parts.append((which, ids))
        ids = np.concatenate([ids for _, ids in parts])
        if len(parts) == 1:
            return ids, n
        order = np.concatenate([which for which, _ in parts])
        first = np.empty(len(n), dtype=np.int64)
        first[order] = np.cumsum(n[order]) - n[order]
        return gather(ids, first, n), n

    def _plain(self, text: str, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(self.plain.encode_batch_fast([text[:-1]], add_special_tokens=False)[0].ids, dtype=np.int32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(size) or last[-1] != len(ids) - 1:
            return self._whole(text, size)
        return ids, np.diff(last, prepend=-1)

    def _whole(self, text: str, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        joined = self.tokenizer.encode(text, add_special_tokens=False)
        # offsets count characters
        begin = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype="<u4") == 0x20) + 1
        at = np.searchsorted(begin, [a for a, _ in joined.offsets], side="right")
        return np.array(joined.ids, dtype=np.int32), np.bincount(at, minlength=len(size))

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and how many each has."""
        whole = {i for i, t in enumerate(texts) if b"<|" in t}  # may hold a special token's string
        ids, n = self.words.texts([b"" if i in whole else t.translate(_LOWER) for i, t in enumerate(texts)])
        if not whole:
            return ids, n
        parts = np.split(ids, np.cumsum(n)[:-1])
        for i in whole:
            parts[i] = np.array(self.tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids, dtype=ids.dtype)
        return np.concatenate(parts), np.array([len(p) for p in parts])


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> LowerCaseTokenizer:
    """A worker that is used again knows the words of its tasks before."""
    return LowerCaseTokenizer(path)


def _with_end(ids: np.ndarray, n: np.ndarray, end: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(n), end)


def write_blocks(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks ``shard, first, n_ids, block`` of all documents' ids, each document's
    closed by ``end_id``, in ascending id order; ``first`` counts the ids before
    the block in its shard.

    Null text is empty: the end id alone.  Rows without id come first; rows that
    repeat an id are ordered by text and all written.  An empty table has no
    blocks; other columns are ignored.  The files lie in the shared folder.
    """
    def run(batches):
        coder = _tokenizer(tokenizer)
        shard, first, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            doc, n, ids = (np.concatenate(c) for c in zip(*held, strict=True))
            return batch_of(_BLOCKS, [shard], [first], [len(ids)], [encode_block(doc, n, ids, coder.size)])

        for rows, texts in slices(batches):
            ids, n = coder.encode(texts)
            ids, n = _with_end(ids, n, end_id), n + 1
            doc, ends, a = rows.column("doc_id").fill_null(_NO_ID).to_numpy(), np.cumsum(n), 0
            while a < len(n):  # documents up to the one that fills the block
                done = int(ends[a - 1]) if a else 0
                z = min(len(n), int(np.searchsorted(ends, done + block_ids - size)) + 1)
                held.append((doc[a:z], n[a:z], ids[done:ends[z - 1]]))
                size, a = size + int(ends[z - 1]) - done, z
                if size >= block_ids:
                    yield block()
                    first, held, size = first + size, [], 0
        if held:
            yield block()

    ordered = (id_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return stage(ordered.mapInArrow(run, "shard int, first long, n_ids long, block binary"), "token-blocks")


def read_blocks(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, ids, ids_crc32`` of every document in the blocks; ``start`` counts the
    ids of all documents before it, ``ids_crc32`` is the CRC of the ids as little-endian
    32-bit integers.  A damaged block fails the read."""
    # one number per shard, of which there are as many as write tasks
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    ends = np.cumsum([0, *(r["n"] for r in sums)])
    before = {r["shard"]: int(b) for r, b in zip(sums, ends, strict=False)}
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32())),
                        ("ids_crc32", pa.int64())])

    def run(batches):
        for b in batches:
            for shard, first, block in zip(*(b.column(c) for c in ("shard", "first", "block")), strict=True):
                doc, n, ids = decode_block(block.as_py())
                at, ids = np.concatenate([[0], np.cumsum(n)]), ids.astype("<i4")
                data = memoryview(ids).cast("B")
                ends = (4 * at).tolist()
                yield batch_of(schema, pa.array(doc, mask=doc == _NO_ID), at[:-1] + before[shard.as_py()] + first.as_py(),
                               pa.ListArray.from_arrays(at.astype(np.int32), ids),
                               [zlib.crc32(data[a:z]) for a, z in zip(ends, ends[1:])])

    return blocks.select("shard", "first", "block").mapInArrow(
        run, "doc_id long, start long, ids array<int>, ids_crc32 long")


def digests(read: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what ``read_blocks`` returns."""
    return read.select("doc_id", "start", F.size("ids").cast("long").alias("n_tokens"), "ids_crc32")
