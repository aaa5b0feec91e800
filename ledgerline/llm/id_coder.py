"""An adaptive context-mixing range coder for token ids, over many independent blocks in lockstep.

Each block starts from nothing. For every id, two predictors name one id each: the one that last followed the two ids
before (order 2) and the one before (order 1), with how often in a row they were right. What they are worth is learned:
adaptive chances, by both counts and whether they agree, mix them with an order-0 model of adaptive counts (of an id's
high byte, and of its low byte given the high one: the high bytes 0 to 2 have a table each, all others share one). The
order-0 intervals are renewed at certain steps only, through the whole block. The mixture is one interval of 2**36, which a range coder narrows.
Encoder and decoder run the same model, all blocks of a batch abreast in numpy, one id of each at a step; every operation
is on all blocks, as picking some of them costs more than it saves. Carries are settled once, when a batch is done.
"""

from __future__ import annotations

import numpy as np

BLOCK = 2048  # ids of a block
LANES = 4096  # blocks abreast
_SLOTS = 11  # bits of a predictor's table
_RENEWED = (32, 64, 128, *range(256, BLOCK, 256))  # the order-0 intervals are renewed after so many ids
_LOWS = 4  # tables of low bytes: one each for the first high bytes, the last for all others
_GAIN = np.float32(24)  # what an id adds to its counts, which start at 1
_U = np.uint64
_WINDOW, _DIGIT = 56, 16  # bits of the coder's window, and of what leaves it at a time
_LEAST = _U(1 << (_WINDOW - _DIGIT))  # an interval narrower than this is widened by a digit
_TOTAL = _U(36)  # bits of the mixture


class _Model:
    """The model of all lanes. `predict` comes before each id, `learn` after it."""

    def __init__(self, steps: int, lanes: int):
        self.lanes, self.step, self.renewed = lanes, 0, 0
        self.ids = np.zeros((steps, lanes), dtype=np.uint32)
        self.literal = np.zeros((min(steps, _RENEWED[-1]), lanes), dtype=bool)
        self.lane = np.arange(lanes, dtype=np.int64)
        self.slots, self.contexts = self.lane << _SLOTS, self.lane << 5
        self.seen1 = np.zeros(lanes << _SLOTS, dtype=np.uint32)  # id * 4 + how often in a row it was right
        self.seen2 = np.zeros(lanes << _SLOTS, dtype=np.uint32)
        self.chance = np.full(lanes * 32, 1024 << 16 | 1024, dtype=np.int32)  # of 4096, of order 2 and order 1
        self.high_count = np.zeros((256, lanes), dtype=np.float32)  # symbols by lanes, so that sums run along whole rows
        self.low_count = np.zeros((256, _LOWS * lanes), dtype=np.float32)
        self.before = np.zeros(lanes, dtype=np.uint32)
        self.earlier = np.zeros(lanes, dtype=np.uint32)

    def cut(self, lanes: int) -> None:
        """Only the first lanes go on."""
        for name in ("lane", "slots", "contexts", "before", "earlier"):
            setattr(self, name, getattr(self, name)[:lanes])

    @staticmethod
    def _intervals(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of intervals in 4096, each at least 1 wide, by the counts: a column's 256 in a row, and every 16th of all."""
        scale = np.float32(4096 - 256) / (256 + _GAIN * counts.sum(axis=0))
        starts = np.zeros(counts.shape, dtype=np.int32)
        gain = _GAIN * scale
        scale += np.float32(1)
        for symbol in range(255):  # what rounding leaves over goes to the last
            width = counts[symbol] * gain
            width += scale
            np.add(starts[symbol], width.astype(np.int32), out=starts[symbol + 1])
        starts = starts.astype(np.uint16)
        flat = np.zeros(counts.size + 1, dtype=np.uint16)
        flat[:-1].reshape(counts.shape[::-1])[:] = starts.T
        return flat, starts[16::16].copy()

    def _renew(self) -> None:
        """Count the ids since the last time, and cut the intervals anew."""
        past, active = slice(self.renewed, self.step), len(self.lane)
        if self.step:
            plain = self.literal[past, :active]
            ids = self.ids[past, :active][plain].astype(np.int64)
            lane = np.broadcast_to(self.lane, plain.shape)[plain]
            high = ids >> 8
            at = ((ids & 255) * _LOWS + np.minimum(high, _LOWS - 1)) * self.lanes + lane
            for counts, places in ((self.high_count, high * self.lanes + lane), (self.low_count, at)):
                counts += np.bincount(places, minlength=counts.size).astype(np.float32).reshape(counts.shape)
        self.high, self.high_rows = self._intervals(self.high_count)
        self.low, self.low_rows = self._intervals(self.low_count)
        self.renewed = self.step

    def low_column(self, high: np.ndarray) -> np.ndarray:
        """Where the starts of low bytes after these high bytes begin."""
        return (np.minimum(high, _LOWS - 1) * self.lanes + self.lane) << 8

    @staticmethod
    def span(table: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the intervals at these places."""
        begin = table.take(at)
        return begin.astype(np.int32), ((table.take(at + 1) - begin) & np.uint16(4095)).astype(np.int32)

    @staticmethod
    def _search(table: np.ndarray, at: np.ndarray, above: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The place of the last start up to the value, from a column's first on; `above` counts such 16th starts."""
        at += above.astype(np.int64) << 4
        for jump in (8, 4, 2, 1):
            at += (table.take(at + jump) <= value) * jump
        return at

    def find_high(self, value: np.ndarray) -> np.ndarray:
        """The place of the high byte whose interval holds the value."""
        above = np.add.reduce((self.high_rows[:, :len(value)] <= value).view(np.uint8), axis=0, dtype=np.uint8)
        return self._search(self.high, self.lane << 8, above, value)

    def find_low(self, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The same for the low byte, after its high byte."""
        above = np.zeros(len(value), dtype=np.uint8)
        for number in range(_LOWS):
            rows = self.low_rows[:, number * self.lanes:number * self.lanes + len(value)] <= value
            held = np.add.reduce(rows.view(np.uint8), axis=0, dtype=np.uint8)
            above = held if not number else np.where(high >= number, held, above)
        return self._search(self.low, self.low_column(high), above, value)

    def predict(self) -> None:
        if self.step == 0 or self.step in _RENEWED:
            self._renew()
        hash1 = self.before * np.uint32(2654435761)
        hash2 = (hash1 ^ self.earlier) * np.uint32(2246822519)
        self.at1 = self.slots + (hash1 >> np.uint32(32 - _SLOTS))
        self.at2 = self.slots + (hash2 >> np.uint32(32 - _SLOTS))
        held1, held2 = self.seen1.take(self.at1), self.seen2.take(self.at2)
        self.id1, self.id2 = held1 >> np.uint32(2), held2 >> np.uint32(2)
        self.run1, self.run2 = held1 & np.uint32(3), held2 & np.uint32(3)
        context = (self.run2 << np.uint32(2)) | self.run1 | ((self.id1 == self.id2).astype(np.uint32) << np.uint32(4))
        self.context = self.contexts + context
        both = self.chance.take(self.context)
        self.p2, self.p1 = both >> 16, both & 0xFFFF
        self.width1 = ((4096 - self.p2) * self.p1) >> 12
        self.used = self.p2 + self.width1

    def learn(self, ids: np.ndarray, right2: np.ndarray, right1: np.ndarray, literal: np.ndarray) -> None:
        """`right1` is for order 1 alone: where both are right, it is order 2 that counts as right."""
        p2 = self.p2 + ((right2 * np.int32(3808) + np.int32(32) - self.p2) >> 4)
        p1 = self.p1 + (((right1 * np.int32(3808) + np.int32(32) - self.p1) >> 4) * ~right2)
        self.chance[self.context] = (p2 << 16) | p1
        packed, one, most = ids << np.uint32(2), np.uint32(1), np.uint32(3)
        self.seen1[self.at1] = packed | (np.minimum(self.run1 + one, most) * (ids == self.id1))
        self.seen2[self.at2] = packed | (np.minimum(self.run2 + one, most) * right2)
        if self.step < len(self.literal):
            self.literal[self.step, :len(ids)] = literal
        self.earlier, self.before = self.before, ids
        self.step += 1

    def interval(self, right2, literal, high, low):
        """Start and width of ids in the mixture; `high` and `low` are their bytes' spans where they are literal."""
        begin = (high[0] << 12) + high[1] * low[0]  # below 2**24
        inner = np.where(literal, high[1] * low[1], 1 << 24)
        whole = np.where(literal, 4096 - self.used, np.where(right2, self.p2, self.width1)).astype(np.int64)
        ahead = np.where(literal, self.used, np.where(right2, 0, self.p2)).astype(np.int64)
        begin *= literal
        return ((ahead << 24) + whole * begin).view(_U), (whole * inner).view(_U)


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Each block of ids (below 65,536) as bytes. Blocks must not grow in length along the list."""
    if not blocks:
        return []
    sizes = np.array([len(block) for block in blocks])
    if (np.diff(sizes) > 0).any():
        raise ValueError("longer blocks come first")
    lanes, steps = len(blocks), int(sizes[0])
    model = _Model(steps, lanes)
    for lane, block in enumerate(blocks):
        model.ids[:len(block), lane] = block
    out = np.zeros((9 * steps // 4 + 2, lanes), dtype=np.uint32)  # digits, which may hold a carry for the one before
    digits = out.ravel()
    place = np.arange(lanes, dtype=np.int64)  # of the next digit
    low, width = np.zeros(lanes, dtype=_U), np.full(lanes, 1 << _WINDOW, dtype=_U)
    active, rest, shift = lanes, _LEAST - _U(1), _U(_WINDOW - _DIGIT)
    for step in range(steps):
        if sizes[active - 1] <= step:
            active = int(np.searchsorted(-sizes, -step, side="left"))
            model.cut(active)
        ids = model.ids[step, :active]
        model.predict()
        right2 = ids == model.id2
        right1 = (ids == model.id1) & ~right2
        literal = ~(right1 | right2)
        wide_ids = ids.astype(np.int64)
        high = wide_ids >> 8
        begin, share = model.interval(
            right2, literal, model.span(model.high, (model.lane << 8) + high),
            model.span(model.low, model.low_column(high) + (wide_ids & 255)))
        lo, wide, to = low[:active], width[:active], place[:active]
        unit = wide >> _TOTAL
        lo += unit * begin
        np.multiply(unit, share, out=wide)
        narrow = wide < _LEAST
        digits[to] = (lo >> shift).astype(np.uint32)  # written again where it is not yet settled
        moved = narrow.astype(_U) << _U(4)
        np.copyto(lo, lo & rest, where=narrow)
        lo <<= moved
        wide <<= moved
        to += narrow * lanes
        again = np.flatnonzero(wide < _LEAST)
        if len(again):
            part = lo[again]
            digits[to[again]] = part >> shift
            lo[again] = (part & rest) << _U(_DIGIT)
            wide[again] <<= _U(_DIGIT)
            to[again] += lanes
        model.learn(ids, right2, right1, literal)
    digits[place] = (low + rest) >> shift  # one more digit picks a value inside, zeros follow
    filled = place // lanes + 1
    for at in range(int(filled.max()) - 1, 0, -1):
        out[at - 1] += np.where(filled > at, out[at] >> np.uint32(_DIGIT), np.uint32(0))
    table = np.ascontiguousarray((out[:int(filled.max())] & np.uint32(0xFFFF)).astype(">u2").T)
    return [table[lane, :size].tobytes() for lane, size in enumerate(filled.tolist())]


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    """The blocks again; `sizes` are their numbers of ids, in the order of `encode`."""
    if not payloads:
        return []
    lanes, counts = len(payloads), np.array(sizes)
    opening = _WINDOW // 8  # bytes
    longest = max(map(len, payloads)) + opening + 8
    longest += (longest - opening) % 2
    data = np.zeros((lanes, longest), dtype=np.uint8)
    for lane, payload in enumerate(payloads):
        data[lane, :len(payload)] = np.frombuffer(payload, dtype=np.uint8)
    code = np.zeros(lanes, dtype=_U)
    for at in range(opening):
        code = (code << _U(8)) | data[:, at]
    digits = np.ascontiguousarray(data[:, opening:]).view(">u2").astype(np.uint16)
    place = np.arange(lanes, dtype=np.int64) * digits.shape[1]
    digits = digits.ravel()
    model = _Model(int(counts[0]), lanes)
    width = np.full(lanes, 1 << _WINDOW, dtype=_U)
    active = lanes
    for step in range(int(counts[0])):
        if counts[active - 1] <= step:
            active = int(np.searchsorted(-counts, -step, side="left"))
            model.cut(active)
        model.predict()
        wide, seen, at = width[:active], code[:active], place[:active]
        unit = wide >> _TOTAL
        value = seen // unit
        np.minimum(value, _U((1 << 36) - 1), out=value)
        expert = (value >> _U(24)).astype(np.int32)
        right2 = expert < model.p2
        literal = expert >= model.used
        right1 = ~(right2 | literal)
        inner = (value - (model.used.astype(_U) << _U(24))) // (4096 - model.used).astype(_U)
        inner = np.where(literal, inner.astype(np.uint32), np.uint32(0))
        at_high = model.find_high((inner >> np.uint32(12)).astype(np.uint16))
        high, first = model.span(model.high, at_high), at_high & 255
        left = (inner - (high[0] << 12).view(np.uint32)) // high[1].view(np.uint32)
        at_low = model.find_low(first, np.minimum(left, np.uint32(4095)).astype(np.uint16))
        begin, share = model.interval(right2, literal, high, model.span(model.low, at_low))
        spelled = ((first << 8) | (at_low & 255)).astype(np.uint32)
        ids = np.where(literal, spelled, np.where(right2, model.id2, model.id1))
        model.ids[step, :active] = ids
        seen -= unit * begin
        np.multiply(unit, share, out=wide)
        for _ in range(2):
            narrow = wide < _LEAST
            moved = narrow.astype(_U) << _U(4)
            seen <<= moved
            seen |= digits.take(at) * narrow
            wide <<= moved
            at += narrow
            if not (wide < _LEAST).any():
                break
        model.learn(ids, right2, right1, literal)
    return [model.ids[:size, lane].copy() for lane, size in enumerate(counts.tolist())]
