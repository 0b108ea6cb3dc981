"""Adaptive context-mixing range coder for token ids.

A block holds the ids of whole documents.  Its ids are dealt to lanes, runs of
consecutive ids, which are coded side by side with one model, one id of every
lane at a time.  The model starts from nothing in each block:

* order 2: the id last seen after the two ids before, with a confidence;
* order 1: the id last seen after the id before, with a confidence;
* order 0: the frequencies of the ids that neither of them foretold, and of ids
  new to it, which are spelled out.

The two confidences, and whether both orders say the same, choose a mixing
context whose adaptive counts give the probabilities that the order-2 prediction
holds, else the order-1 prediction, else that order 0 has to tell.  The model
learns after each round, of one step at first and of up to ``ROUND`` steps later,
so that the ids of a round are learned, and in the coder predicted, all at once.
Each choice is narrowed into a 64-bit range coder per lane.  The lanes' words lie
in one stream in the order in which the decoder asks for them, so no lane needs a
length.  A block carries checksums of its head and of its ids and reads without
any other block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

U = np.uint64
MAGIC = b"TMRC\x02\x00\x00\x00"
_HEAD = struct.Struct("<8sIIQIIII")  # magic, vocabulary, lanes, ids, documents, crc of ids, words, crc of head
LANES = 1024
#: Steps after which the model is brought up to date, at the latest.
ROUND = 32
_WORD, _LEAST = U(32), U(1 << 32)
_BITS2 = 18
_SURE = 4  # bits of a confidence
_MAX = (1 << _SURE) - 1  # largest confidence
_ROUTES, _ROUTE_BITS = 3, 8
_STATES = 2 << 2 * _SURE
#: What is added to an id with its confidence, by the confidence and whether the id came again.
_CHANGE = np.array([*((s >> 1) - s for s in range(_MAX + 1)), *[1] * _MAX, 0], dtype=np.int32)


class Model:
    def __init__(self, vocabulary: int):
        if vocabulary >= 1 << 23:  # more bits could leave a part of a range empty
            raise ValueError("the vocabulary is too large")
        #: Bits of the frequencies' sum; ``vocabulary`` stands for a new id there.
        self.vocabulary, self.bits = vocabulary, max(17, vocabulary.bit_length() + 1)
        #: Ids with confidence after two ids, then after one.
        self.after = np.zeros((1 << _BITS2) + vocabulary + 1, dtype=np.int32)
        self.routes = np.ones(_ROUTES * _STATES, dtype=np.int64)
        self.count = np.zeros(vocabulary + 1, dtype=np.int64)
        self.count[vocabulary] = 1
        self.seen = np.array([vocabulary])
        self.start, self.size = (np.zeros(vocabulary + 1, dtype=U) for _ in range(2))
        self._refresh()

    def _refresh(self) -> None:
        upto = np.cumsum(self.routes.reshape(-1, _ROUTES), axis=1)
        upto = upto * ((1 << _ROUTE_BITS) - _ROUTES) // upto[:, -1:] + np.arange(1, _ROUTES + 1)
        size = upto.copy()
        size[:, 1:] -= upto[:, :-1]
        #: By mixing context and route.
        self.route_size, self.route_start = size.ravel().astype(U), (upto - size).ravel().astype(U)
        count = self.count[self.seen]
        self.sizes = 1 + count * ((1 << self.bits) - len(count)) // count.sum()
        self.sizes[count.argmax()] += (1 << self.bits) - self.sizes.sum()
        self.start[self.seen], self.size[self.seen] = np.cumsum(self.sizes) - self.sizes, self.sizes

    def owners(self) -> tuple[np.ndarray, np.ndarray]:
        """The route that each unit of each mixing context belongs to, and the id that each
        unit of the frequencies' sum does."""
        routes = np.tile(np.arange(_ROUTES, dtype=np.uint8), _STATES)
        return np.repeat(routes, self.route_size.astype(np.int64)), np.repeat(self.seen.astype(np.int32), self.sizes)

    @staticmethod
    def places(before2: np.ndarray, before1: np.ndarray) -> np.ndarray:
        """Where the model keeps what comes after two ids, and after one."""
        out = np.empty((2, len(before1)), dtype=np.int32)
        both = before2.view(np.uint32) * np.uint32(0x9E3779B1) + before1.view(np.uint32) * np.uint32(0x85EBCA77)
        np.right_shift(both, np.uint32(32 - _BITS2), out=out[0].view(np.uint32))
        np.add(before1, np.int32(1 << _BITS2), out=out[1])
        return out

    def predict(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What is kept there, the ids of that, and the mixing context."""
        held = self.after.take(places)
        guess, sure = held >> _SURE, held & _MAX
        state = (sure[0] << _SURE) + sure[1]
        return held, guess, (state << 1) + (guess[0] == guess[1])

    def learn(self, ids, places, held, guess, state, route) -> None:
        sure = held & _MAX
        hit = guess == ids
        kept = held + _CHANGE.take(sure + (hit.view(np.int8) << np.int8(_SURE)))
        other = (ids << _SURE) + 1
        # of ids in one context the last one writes, in the coder and the decoder alike
        self.after[places] = other + (kept - other) * (hit | (sure > 1))
        self.routes += 24 * np.bincount(state * _ROUTES + route, minlength=len(self.routes))
        if self.routes.max() > 1 << 20:
            self.routes = (self.routes + 1) >> 1
        told = ids[route == _ROUTES - 1]
        new = told[self.size.take(told) == 0]
        self.count[-1] += len(new)
        self.seen = np.concatenate([self.seen, np.unique(new)])
        self.count += np.bincount(told, minlength=len(self.count))
        self._refresh()


class _Encoder:
    def __init__(self, lanes: int, steps: int):
        self.low, self.range = np.zeros(lanes, dtype=U), np.full(lanes, _LEAST, dtype=U)
        # all words but the last one of each lane, with the carries into them; the first two are always 0
        self.out = np.zeros(lanes * (2 * steps + 4), dtype=U)
        self.at = np.arange(lanes, dtype=np.int64) * (2 * steps + 4)
        self.last = np.zeros(lanes, dtype=U)
        # the decoder begins with one word of each lane; whenever it is done with one, it asks for the next
        self.asked = [self.at + 2]

    def put(self, lanes, *choices) -> None:
        """Narrows lanes by each ``(start, size, bits)`` to ``size`` parts from ``start`` on, of ``1 << bits``."""
        range_, more = self.range[lanes], U(0)
        for start, size, bits in choices:
            part = range_ >> bits
            more, range_ = more + start * part, size * part
        low = self.low[lanes] + more
        self.last[lanes] += low < more
        self.low[lanes], self.range[lanes] = low, range_

    def settle(self, lanes: int) -> None:
        lane, = (self.range[:lanes] < _LEAST).nonzero()
        if len(lane):
            at, low = self.at[lane], self.low[lane]
            self.out[at] = self.last[lane]
            self.asked.append(at + 3)
            self.at[lane] = at + 1
            self.last[lane], self.low[lane] = low >> _WORD, low << _WORD
            self.range[lane] <<= _WORD

    def end(self) -> bytes:
        self.out[self.at], self.out[self.at + 1], self.out[self.at + 2] = (
            self.last, self.low >> _WORD, self.low & (_LEAST - U(1)))
        while len(over := np.flatnonzero(self.out >= _LEAST)):
            self.out[over] &= _LEAST - U(1)
            self.out[over - 1] += U(1)
        return self.out[np.concatenate(self.asked)].astype("<u4").tobytes()


class _Decoder:
    def __init__(self, lanes: int, data: np.ndarray):
        self.data, self.at = data, lanes
        self.code, self.range = data[:lanes].astype(U), np.full(lanes, _LEAST, dtype=U)

    def settle(self, lanes: int) -> None:
        lane, = (self.range[:lanes] < _LEAST).nonzero()
        if len(lane):
            words = self.data[self.at:self.at + len(lane)]
            if len(words) < len(lane):
                raise ValueError("damaged ids")
            self.at += len(lane)
            self.code[lane] = (self.code[lane] << _WORD) | words
            self.range[lane] <<= _WORD

    def parts(self, lanes, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The part of ``1 << bits`` that each lane stands in, the size of a part, and the code."""
        code, part = self.code[lanes], self.range[lanes] >> U(bits)
        return (code // part).astype(np.int64), part, code

    def take(self, lanes, code, start, size, part) -> None:
        self.code[lanes] = code - start * part
        self.range[lanes] = size * part


def _shape(n: int) -> tuple[int, int]:
    """Lanes, and ids of the longest of them."""
    lanes = max(1, min(LANES, n // 32))
    return lanes, -(-n // lanes)


def _rounds(steps: int):
    """``(first step, end)`` of each round."""
    a = 0
    while a < steps:
        z = min(steps, a + max(1, min(ROUND, a // 4)))
        yield a, z
        a = z


def _running(n: int, lanes: int, steps: int) -> np.ndarray:
    """How many lanes still run in each step; lanes hold ``steps`` ids each, the last ones fewer."""
    return np.minimum(lanes, -(-(n - np.arange(steps)) // steps))


def _payload(ids: np.ndarray, vocabulary: int) -> bytes:
    n = len(ids)
    lanes, steps = _shape(n)
    running = _running(n, lanes, steps)
    ends = np.concatenate([[0], np.cumsum(running)])
    # by step: two steps before the first, and the ids
    rows = np.full((steps + 2, lanes), vocabulary, dtype=np.int32)
    rows[2:] = np.resize(ids, lanes * steps).reshape(lanes, steps).T
    runs = np.arange(lanes) < running[:, None]
    before2, before1, ids = (rows[k:k + steps][runs] for k in range(3))
    places = Model.places(before2, before1)
    coder, model = _Encoder(lanes, steps), Model(vocabulary)
    for a, z in _rounds(steps):
        x, where = ids[ends[a]:ends[z]], places[:, ends[a]:ends[z]]
        held, guess, state = model.predict(where)
        wrong2, wrong1 = x != guess[0], x != guess[1]
        told = wrong2 & wrong1
        route = wrong2.astype(np.int32) + told
        cell = state * _ROUTES + route
        start, size = model.route_start.take(cell), model.route_size.take(cell)
        new = told & (model.size.take(x) == 0)
        order0 = np.where(new, vocabulary, x)
        bits = told * U(model.bits)
        start0 = model.start.take(order0) * told
        size0 = np.where(told, model.size.take(order0), U(1))
        any_new = new.any()
        for k, i in zip(running[a:z].tolist(), (ends[a:z] - ends[a]).tolist(), strict=True):
            lane, part = slice(k), slice(i, i + k)
            coder.put(lane, (start[part], size[part], U(_ROUTE_BITS)), (start0[part], size0[part], bits[part]))
            coder.settle(k)
            if any_new and len(lane := np.flatnonzero(new[part])):
                coder.put(lane, (x[part][lane].astype(U), U(1), U(model.bits)))
                coder.settle(k)
        model.learn(x, where, held, guess, state, route)
    return coder.end()


def _ids(data: np.ndarray, n: int, lanes: int, vocabulary: int) -> np.ndarray:
    steps = -(-n // lanes)
    running = _running(n, lanes, steps).tolist()
    coder, model = _Decoder(lanes, data), Model(vocabulary)
    ids = np.zeros((steps, lanes), dtype=np.int32)
    x = before = np.full(lanes, vocabulary, dtype=np.int32)
    for a, z in _rounds(steps):
        done = []
        route_of, id_of = model.owners()
        for k, out in zip(running[a:z], ids[a:z], strict=True):
            places = model.places(before[:k], x[:k])
            before = x
            held, guess, state = model.predict(places)
            every = slice(k)
            v, part, code = coder.parts(every, _ROUTE_BITS)
            route = route_of.take((state << _ROUTE_BITS) + v)
            cell = state * _ROUTES + route
            coder.take(every, code, model.route_start.take(cell), model.route_size.take(cell), part)
            x = guess[0] + (guess[1] - guess[0]) * route  # those of order 0 follow
            lane, = (route == _ROUTES - 1).nonzero()
            v, part, code = coder.parts(lane, model.bits)
            x[lane] = y = id_of.take(v)
            coder.take(lane, code, model.start.take(y), model.size.take(y), part)
            coder.settle(k)
            new = y == vocabulary
            if np.count_nonzero(new):
                lane = lane[new]
                v, part, code = coder.parts(lane, model.bits)
                x[lane] = v
                coder.take(lane, code, v.astype(U), U(1), part)
                coder.settle(k)
            out[:k] = x
            done.append((x, places, held, guess, state, route))
        model.learn(*(np.concatenate(c, axis=-1) for c in zip(*done, strict=True)))
    return ids.T.ravel()[:n].astype(np.int64)


def encode_block(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, vocabulary: int) -> bytes:
    """One block: the ids of ``len(doc_ids)`` documents, ``lengths`` of each."""
    ids = np.asarray(ids, dtype=np.int64)
    if len(ids) and not 0 <= ids.min() <= ids.max() < vocabulary:
        raise ValueError("an id lies outside the vocabulary")
    payload, lanes = b"", 0
    if len(ids):
        lanes, payload = _shape(len(ids))[0], _payload(ids, vocabulary)
    body = np.asarray(doc_ids, dtype="<i8").tobytes() + np.asarray(lengths, dtype="<u4").tobytes()
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    head = _HEAD.pack(MAGIC, vocabulary, lanes, len(ids), len(doc_ids), crc, len(payload) // 4, 0)
    head = _HEAD.pack(MAGIC, vocabulary, lanes, len(ids), len(doc_ids), crc, len(payload) // 4,
                      zlib.crc32(body, zlib.crc32(head)))
    return head + body + payload


def decode_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(doc_ids, lengths, ids)``; ``ValueError`` if the block is damaged."""
    if len(block) < _HEAD.size:
        raise ValueError("not a block")
    magic, vocabulary, lanes, n, docs, crc, size, head_crc = _HEAD.unpack_from(block)
    at = _HEAD.size
    body = block[at:at + docs * 12]
    if magic != MAGIC or len(block) != at + len(body) + 4 * size or head_crc != zlib.crc32(
            body, zlib.crc32(_HEAD.pack(magic, vocabulary, lanes, n, docs, crc, size, 0))):
        raise ValueError("damaged head")
    doc_ids = np.frombuffer(body, "<i8", docs)
    lengths = np.frombuffer(body, "<u4", docs, docs * 8).astype(np.int64)
    ids = np.zeros(n, dtype=np.int64)
    if n:
        if size < lanes:
            raise ValueError("damaged ids")
        try:
            ids = _ids(np.frombuffer(block, "<u4", size, at + len(body)), n, lanes, vocabulary)
        except IndexError:  # no id or route stands there
            raise ValueError("damaged ids") from None
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("damaged ids")
    return doc_ids, lengths, ids
