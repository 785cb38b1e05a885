"""Best-fit packing into sequences by bin completion.

Texts become token ids and are cut, only if longer, into pieces of at most `room` ids.  What is solved
on the driver is the histogram of piece lengths, `room` numbers whatever the input.  Best-fit decreasing gives the
first incumbent.  Around the largest length left, undominated fillings of any number of pieces are tried, fullest
first, each taken as often as its lengths last and, after all others, fewer times.  A branch is pruned when its
waste exceeds what the incumbent minus one sequence leaves.  This search ends at the lower bound, or when it has
tried all, or after `nodes` fillings, dominated ones that it met included.

If the bound isn't reached, the incumbent is mended: a few of its sequences, those with the most waste first, are
opened and completed anew around their largest pieces with the fullest fillings, and taken over if they need fewer
sequences or have their waste in fewer of them.  This ends at the bound or after `tries` such attempts; nothing else
limits either search, and `solve` says whether its result is proven least.  Pieces then find their place by their
rank among pieces of equal length.

Null and empty texts are the closing id alone; texts of any length are cut whole; repeated rows are packed one by
one; pieces of equal length take their places in the order of id and piece; an empty table gives no rows; other columns
aren't read.
"""

from __future__ import annotations

import bisect
import json
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palaver.llm.common import Shared, cut, ranked

ROOM, CLOSING, NODES, TRIES = 1024, 2, 5_000, 20_000


class Encoder:
    """Ids of a byte-level BPE vocabulary file of the tokenizers library.

    The file's merges run in a faster library; texts that hold a special token, and those on which
    that library fails, go through tokenizers itself.
    """

    def __init__(self, content: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        model = json.loads(content)
        special = {x["content"]: x["id"] for x in model.get("added_tokens", ())}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        # the other bytes stand as the characters from U+0100 on, in their order
        letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(x for x in range(256) if x not in plain)}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        self.slow, self.special = Tokenizer.from_str(content), list(special)
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> Encoder:
        return cls(*vocabulary(path))

    def __call__(self, text: str) -> list[int]:
        if not any(s in text for s in self.special):
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as error:  # noqa: BLE001  a panic of the library isn't an Exception
                if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                    raise
        return self.slow.encode(text, add_special_tokens=False).ids


def vocabulary(path: str) -> tuple[str, str]:
    """The file's content and the pattern that splits texts before merging; read on the driver, shipped to executors."""
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as f:
        return f.read(), PATTERN


def pieces(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, closing: int = CLOSING) -> DataFrame:
    """One row a piece: the first may be shorter than `room`, the others are full."""
    id_type = docs.schema[id_col].dataType.simpleString()
    shared = Shared(docs.sparkSession, vocabulary(path))

    def run(batches):
        encode = None
        for batch in batches:
            encode = encode or Encoder(*shared.value)
            columns = ([], [], [], [], [])
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), closing], "<u4")
                at, size = 0, len(ids) % room or room
                for piece in range(-(-len(ids) // room)):
                    for column, value in zip(columns, (key, piece, at, size, zlib.crc32(ids[at : at + size].tobytes())), strict=True):
                        column.append(value)
                    at, size = at + size, room
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "piece", "start", "length", "ids_crc32"])

    return docs.select(id_col, text_col).mapInArrow(run, f"id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint").withColumnRenamed("id", id_col)


def lower_bound(counts: list[int], room: int) -> int:
    """Sequences needed at least: all ids by room, or every length over half by itself with what cannot join."""
    best = -(-sum(s * n for s, n in enumerate(counts)) // room)
    for k in range(1, room // 2 + 1):
        if not counts[k] and k > 1:
            continue
        alone = sum(counts[room - k + 1 :])
        halves = sum(counts[room // 2 + 1 : room - k + 1])
        free = halves * room - sum(s * counts[s] for s in range(room // 2 + 1, room - k + 1))
        small = sum(s * counts[s] for s in range(k, room // 2 + 1))
        best = max(best, alone + halves + max(0, -(-(small - free) // room)))
    return best


def _best_fit(counts: list[int], room: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over the histogram: the largest lengths that still fit, again and again."""
    left, out = counts[:], []
    for size in range(room, 0, -1):
        while left[size]:
            filling, free = {size: 1}, room - size
            at = min(free, size)
            while at > 0:
                take = min(left[at] - (at == size), free // at)
                if take > 0:
                    filling[at] = filling.get(at, 0) + take
                    free -= take * at
                at = min(at - 1, free)
            times = min(left[s] // n for s, n in filling.items())
            for s, n in filling.items():
                left[s] -= n * times
            out.append((tuple(s for s, n in filling.items() for _ in range(n)), times))
    return out


def _sums(sizes: list[int], have: list[int], room: int) -> list[int]:
    """For k = 0, 1, ...: the sums up to `room` of the first k sizes, each used at most as often as it is there, as bit sets."""
    out, mask = [1], (1 << (room + 1)) - 1
    for s, n in zip(sizes, have, strict=True):
        reach, n, step = out[-1], min(n, room // s), 1
        while n:
            step = min(step, n)
            reach |= reach << (step * s) & mask
            n, step = n - step, step * 2
        out.append(reach)
    return out


def _dominated(filling: tuple[int, ...], left: int, waste: int) -> bool:
    """Whether a piece left, of the lengths in the bit set, could join the filling or take the place of some of its pieces.

    That is: of none, of one that is shorter, or of several that are no longer together, if it fits.
    """
    one = several = 0
    for s in filling:
        several |= several << s | one << s
        one |= 1 << s
    return bool(left & several) or any(left >> k & (1 | one | several) for k in range(1, waste + 1))


def _fillings(counts: list[int], size: int, room: int):
    """Undominated fillings around a piece of `size`, of any number of pieces, fullest first; None for each dominated one met."""
    free = room - size
    sizes = [s for s in range(1, min(free, size) + 1) if counts[s] > (s == size)]
    have = [counts[s] - (s == size) for s in sizes]
    reach = _sums(sizes, have, free)

    def exact(k: int, rest: int):
        # every sum in reach is met by some choice, so no branch ends empty
        if not rest:
            yield ()
            return
        k = min(k, bisect.bisect_right(sizes, rest))
        while k and reach[k] >> rest & 1:
            k -= 1
            s = sizes[k]
            for n in range(min(have[k], rest // s), 0, -1):
                if reach[k] >> (rest - n * s) & 1:
                    for others in exact(k, rest - n * s):
                        yield (s,) * n + others

    whole = sum(1 << s for s in sizes)
    for target in range(free, -1, -1):
        waste = free - target
        # a length that fits into the waste must be used up
        short = sum(s * n for s, n in zip(sizes[: bisect.bisect_right(sizes, waste)], have, strict=False))
        if not reach[-1] >> target & 1 or short > target:
            continue
        for filling in exact(len(sizes), target):
            used = sum(1 << s for s in set(filling) if have[bisect.bisect_left(sizes, s)] == filling.count(s))
            yield None if _dominated(filling, whole ^ used, waste) else (size, *filling)


def _choices(counts: list[int], room: int):
    """Fillings around the largest length left with how often to take them: first as often as they last, later fewer times."""
    counts = counts[:]
    size = max((s for s, n in enumerate(counts) if n), default=0)
    for fewer in (False, True) if size else ():
        for filling in _fillings(counts, size, room):
            if filling is None:
                yield None
                continue
            most = min(counts[s] // filling.count(s) for s in set(filling))
            for times in range(most - 1, 0, -1) if fewer else (most,):
                yield filling, times


def _searched(counts: list[int], room: int, bound: int, best: list, nodes: int) -> list[tuple[tuple[int, ...], int]]:
    """The fewest fillings that the branch and bound finds from the incumbent `best` on."""
    fewest, total = sum(n for _, n in best), sum(s * n for s, n in enumerate(counts))
    # depth first; an entry is the state before a filling: lengths left, its choices, waste so far
    left, path, waste = counts[:], [], 0
    stack, spent = [_choices(left, room)], 0
    while stack and fewest > bound and spent < nodes:
        choice = next(stack[-1], False)
        if choice is False:
            stack.pop()
            if path:
                done, times = path.pop()
                waste -= times * (room - sum(done))
                for s in done:
                    left[s] += times
            continue
        spent += 1
        if choice is None:
            continue
        filling, times = choice
        lost = waste + times * (room - sum(filling))
        if total + lost > (fewest - 1) * room:
            continue
        for s in filling:
            left[s] -= times
        path.append(choice)
        waste = lost
        if not any(left):
            used = sum(n for _, n in path)
            if used < fewest:
                fewest, best = used, path[:]
        stack.append(_choices(left, room))
    return best


def _completed(left: Counter, room: int, rng: random.Random, width: int) -> list[tuple[int, ...]]:
    """Sequences of a few pieces: around the largest one left the fullest filling, its lengths drawn from the `width` largest that allow it."""
    left, out = +left, []
    while left:
        size = max(left)
        left[size] -= 1
        left = +left
        sizes = sorted(s for s in left if s <= room - size)
        have = [left[s] for s in sizes]
        reach = _sums(sizes, have, room - size)
        rest, k, filling = reach[-1].bit_length() - 1, len(sizes), [size]
        while rest:
            k, found = min(k, bisect.bisect_right(sizes, rest)), []
            while k and len(found) < width:
                k -= 1
                most = min(have[k], rest // sizes[k])
                found += [(k, n) for n in range(most, 0, -1) if reach[k] >> (rest - n * sizes[k]) & 1][:1]
            k, n = rng.choice(found)
            filling += [sizes[k]] * n
            rest -= n * sizes[k]
        left -= Counter(filling[1:])
        out.append(tuple(filling))
    return out


def _mended(room: int, bound: int, best: list, tries: int) -> list[tuple[tuple[int, ...], int]]:
    """The incumbent after up to `tries` attempts at completing a few of its sequences anew."""
    rng, held = random.Random(0), Counter()
    for filling, times in best:
        held[filling] += times
    # a full piece alone can't be mended
    fewest = sum(held.values())
    order = sorted((sum(f) - room, f) for f in held if f != (room,))
    unused = lambda fillings: sum((room - sum(f)) ** 2 for f in fillings)
    while fewest > bound and tries and order:
        tries -= 1
        picked = Counter([order[0][1]] if rng.random() < 0.5 else [])
        for _ in range(rng.randrange(2, 9) - len(picked)):
            filling = order[int(rng.random() ** 2 * len(order))][1]
            if picked[filling] < held[filling]:
                picked[filling] += 1
        opened = list(picked.elements())
        made = _completed(Counter(s for f in opened for s in f), room, rng, rng.choice((1, 2, 4)))
        if len(made) > len(opened) or len(made) == len(opened) and unused(made) < unused(opened):
            continue
        fewest += len(made) - len(opened)
        for filling, change in ((f, d) for fs, d in ((opened, -1), (made, 1)) for f in fs):
            before, entry = held[filling], (sum(filling) - room, filling)
            held[filling] += change
            if filling != (room,) and not before:
                bisect.insort(order, entry)
            if filling != (room,) and not held[filling]:
                del order[bisect.bisect_left(order, entry)]
    return sorted((+held).items(), reverse=True)


def solve(counts: list[int], room: int = ROOM, nodes: int = NODES, tries: int = TRIES) -> tuple[list[tuple[tuple[int, ...], int]], bool]:
    """Fillings and how often each is used (`counts[s]` pieces have length s), and whether they are as few as the lower bound."""
    bound = lower_bound(counts, room)
    best = _searched(counts, room, bound, _best_fit(counts, room), nodes)
    best = _mended(room, bound, best, tries)
    return best, sum(n for _, n in best) == bound


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple]:
    """For every length: where its ranks go, as (from, each, sequence, offset) in order of `from`."""
    taken, out, sequence = {}, {}, 0
    for filling, times in patterns:
        at = 0
        for size in sorted(set(filling), reverse=True):
            each = filling.count(size)
            out.setdefault(size, []).append((taken.get(size, 0), each, sequence, at))
            taken[size] = taken.get(size, 0) + each * times
            at += each * size
        sequence += times
    return [(size, places) for size, places in out.items()]


def pack(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM, closing: int = CLOSING, nodes: int = NODES, tries: int = TRIES) -> DataFrame:
    """One row a piece with `sequence_id` and `offset`."""
    cutout = cut(pieces(docs, path, id_col=id_col, text_col=text_col, room=room, closing=closing))
    counts = [0] * (room + 1)
    for size, n in cutout.groupBy("length").count().collect():
        counts[size] = n
    kind = "length bigint, places array<struct<from:bigint,each:bigint,sequence:bigint,at:bigint>>"
    table = docs.sparkSession.createDataFrame(_places(solve(counts, room, nodes, tries)[0]), kind)
    rows = ranked(cutout, ["length"], [id_col, "piece"], "_rank").join(F.broadcast(table), "length")
    place = F.element_at(F.filter("places", lambda p: p["from"] <= F.col("_rank")), -1)
    rows = rows.withColumn("_place", place)
    past = F.col("_rank") - F.col("_place.from")
    sequence = F.col("_place.sequence") + F.floor(past / F.col("_place.each"))
    offset = F.col("_place.at") + past % F.col("_place.each") * F.col("length")
    return rows.select(id_col, "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), offset.alias("offset"))
