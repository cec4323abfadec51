r"""Token counts by a compiled finite-state transducer.

The byte-pair merges are compiled, as texts need it, into a deterministic
transducer over bytes.  Its state after a prefix of a word is what the rest can
still depend on: the last token of the prefix's encoding, and for every start
from which a longer token may yet be read, the node reached in the trie of
tokens, the last token there and how many tokens lie between.  A token may
follow another if the pair encodes to itself, and just one of the tokens that
end at a byte may follow the encoding at its start; so each transition is
determined, and it carries the change of the number of tokens.  At the start of
a word, which is found from the classes of a few neighbouring characters, the
transducer is in its first state whatever went before.

Texts are cut into chunks of some sixty bytes that begin at word starts, so that
a chunk's map has one entry state; all chunks of a window are read in step, a
byte of each at a time, and their counts are added up.  A text over ``SPLIT``
characters is dealt over tasks in segments.  A segment that has to begin inside
a word (a run of one class of characters over a thousand long) is read from the
state that the characters before it lead to; its map is from that entry state to
its exit state and count.  Maps of neighbours compose where exit and entry are
equal; a text for which they are not is read in order by one task.

Defined cases: null and empty texts have no bytes and no tokens; strings of
special tokens in a text count as that token, as the library does by default;
repeated rows each get a row; extra columns are kept out.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minewright.llm.units import WHITE
from minewright.staging import shuffle_width, stage

#: Characters read in step, characters of a segment, bytes of a chunk, and bytes from which a chunk is read by itself.
WINDOW, SPLIT, CHUNK, LONG = 1 << 18, 4_000_000, 64, 1024
_NEVER = 1 << 60
#: Slots of the direct-mapped table, as a power of two.
_SLOTS = 20
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


@functools.cache
def _classes() -> np.ndarray:
    """Class of every character: white space, letter, number or other."""
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, f"[{WHITE}]+")):
        for m in regex.finditer(pattern, every):
            # Surrogates are left out of ``every``, so places behind them are moved.
            out[m.start() + (0x800 if m.start() >= 0xD800 else 0) : m.end() + (0x800 if m.end() > 0xD800 else 0)] = kind
    return out


def word_starts(codes: np.ndarray, begin: np.ndarray, open_left: bool = False) -> np.ndarray:
    """Where a pre-token starts, for strings one after the other that begin at ``begin``; ``open_left``: the first goes on inside a run of one class."""
    kind = _classes()[codes]
    edge = np.ones(len(codes) + 1, bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[begin] = True
    ends = np.zeros(len(codes) + 1, bool)
    ends[begin], ends[-1] = True, True
    run = np.flatnonzero(edge)
    lo, hi = run[:-1], run[1:]
    start = edge[:-1].copy()
    if open_left:
        start[0] = False
    white = kind[lo] == _SPACE
    # White space before something else: its last character stands alone, and a space there belongs to what follows.
    inner = white & ~ends[hi]
    start[hi[inner] - 1] = True
    glued = hi[inner & (codes[hi - 1] == 32)]
    start[glued] = False
    # Contractions: a lone apostrophe at a start with s, t, m, d, re, ve or ll after it.
    at = lo[(kind[lo] == _OTHER) & (hi - lo == 1) & (codes[lo] == 39) & start[lo] & ~ends[hi]]
    if len(at):
        size = np.append(hi - lo, 0)[np.searchsorted(lo, at) + 1]
        at, size = at[kind[at + 1] == _LETTER], size[kind[at + 1] == _LETTER]
        a, b = codes[at + 1], codes[np.minimum(at + 2, len(codes) - 1)]
        two = (size > 1) & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        one = np.isin(a, [ord(c) for c in "stmd"])
        hit = one | two
        start[at[hit] + 1] = False
        more = hit & (size > np.where(one, 1, 2))
        start[(at + 1 + np.where(one, 1, 2))[more]] = True
    return start


def cut_at(text: str, size: int) -> tuple[int, bool]:
    """A place to cut near ``size``, and whether it is inside a run of one class: at a sure word start in the thousand characters before, if there is one.

    The end of a run is a sure start unless it is white space, which what follows may take up, or the apostrophe of a contraction.
    """
    low = max(size - LONG, 1)
    codes = np.frombuffer(text[low - 1 : size + 1].encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _classes()[codes]
    change = kind[1:] != kind[:-1]
    sure = np.flatnonzero(change & (kind[:-1] != _SPACE) & ~((codes[:-1] == 39) & (kind[1:] == _LETTER)))
    if len(sure):
        return low + int(sure[-1]), False
    inside = np.flatnonzero(~(change[3:] | change[2:-1] | change[1:-2] | change[:-3])) + 3  # far enough from a contraction's apostrophe
    return (low + int(inside[-1]), True) if len(inside) else (len(text), False)


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable ones themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def merge(symbols: list[bytes], rank: dict[tuple[bytes, bytes], int], last: list | None = None) -> list[bytes]:
    """Byte-pair encoding: the best-ranked pair first, the left one of equals; ``last`` gets the pair merged last."""
    parts: list[bytes | None] = list(symbols)
    right = list(range(1, len(parts) + 1))
    left = list(range(-1, len(parts) - 1))
    heap = [(rank[p], i) for i in range(len(parts) - 1) if (p := (parts[i], parts[i + 1])) in rank]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if parts[i] is None or (j := right[i]) >= len(parts) or rank.get((parts[i], parts[j])) != r:
            continue
        if last is not None:
            last[:] = [(parts[i], parts[j])]
        parts[i], parts[j] = parts[i] + parts[j], None
        right[i] = right[j]
        if right[i] < len(parts):
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < len(parts) and (p := (parts[a], parts[b])) in rank:
                heapq.heappush(heap, (rank[p], a))
    return [p for p in parts if p is not None]


class Transducer:
    """The lazily determinised token counter of one byte-level vocabulary; at most ``bound`` transitions are kept."""

    def __init__(self, path: str, bound: int = 500_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(as_bytes(a), as_bytes(b)): i for i, (a, b) in enumerate(pairs)}
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}  # the pair whose merge makes a token
        for token in (as_bytes(s) for s in spec["model"]["vocab"] if s not in special):
            pair: list[tuple[bytes, bytes]] = []
            if merge([token[i : i + 1] for i in range(len(token))], self.rank, pair) == [token]:  # others are never output
                if pair:
                    self.halves[token] = pair[0]
                node = 0
                for b in token:
                    if b not in self.trie[node]:
                        self.trie[node][b] = len(self.trie)
                        self.trie.append({})
                        self.token.append(None)
                    node = self.trie[node][b]
                self.token[node] = token
        self.bound = bound
        self.spines: tuple[dict, dict] = ({}, {})
        over = [t for t, (a, b) in self.halves.items() for h in (a, b) if h in self.halves and self.rank[self.halves[h]] >= self.rank[a, b]]
        if over:
            raise ValueError(f"a part of {over[0]!r} is merged after it: the vocabulary's merges are not in the order of their making")
        self.reset()

    def reset(self) -> None:
        """Forget all states but the start, whose only live place is the root with nothing before it."""
        self.state = {(((0, None, 0),), None): 0}
        self.keys_of = [(((0, None, 0),), None)]
        self.places = [((0, None, 0),)]
        self.table: dict[int, int] = {}  # state and byte -> next state and change, packed
        self.keys, self.values = np.full(1 << _SLOTS, -1, np.int64), np.zeros(1 << _SLOTS, np.int64)

    def spine(self, token: bytes, side: int) -> tuple[tuple[bytes, int], ...]:
        """What stands at an end of a token (0 its right, 1 its left) as its merges go on: each part with the rank of the merge that takes it up."""
        if (found := self.spines[side].get(token)) is None:
            if (pair := self.halves.get(token)) is None:
                found = ((token, _NEVER),)
            else:
                inner = self.spine(pair[1 - side], side)
                found = (*inner[:-1], (inner[-1][0], self.rank[pair]), (token, _NEVER))
            self.spines[side][token] = found
        return found

    def may_follow(self, a: bytes | None, b: bytes) -> bool:
        """Whether the pair encodes to itself: no merge over the boundary comes before those on either side of it.

        Merges take place in the order of their ranks, the left one of equals first, and a token's rank is over
        those of its parts; so only the parts at the boundary matter.
        """
        if a is None:
            return True
        left, right, rank = self.spine(a, 0), self.spine(b, 1), self.rank
        i = j = 0
        while True:
            (x, ra), (y, rb) = left[i], right[j]
            over = rank.get((x, y), _NEVER)
            if over < ra and over <= rb and over != _NEVER:
                return False
            if ra == rb == _NEVER:
                return True
            if ra <= rb:
                i += 1
            else:
                j += 1

    def compile(self, s: int, b: int) -> int:
        """The transition from state ``s`` on byte ``b``: the next state and the change of the count, packed."""
        moved = [(self.trie[node][b], last, n) for node, last, n in self.places[s] if b in self.trie[node]]
        node, last, n = next(x for x in moved if (t := self.token[x[0]]) is not None and self.may_follow(x[1], t))
        token, change = self.token[node], n + 1
        live = tuple((node, last, n - change) for node, last, n in moved if self.trie[node]) + ((0, token, 0),)
        key = (live, token)
        if key not in self.state:
            self.state[key] = len(self.places)
            self.places.append(live)
            self.keys_of.append(key)
        self.table[s << 8 | b] = found = self.state[key] << 12 | change + 2048
        return found

    def change(self, s: int, b: int) -> int:
        if (found := self.table.get(s << 8 | b)) is None:
            found = self.compile(s, b)
        return found

    def steps(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Transitions of many states at once, from a direct-mapped copy of the table."""
        key = state << 8 | byte
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _SLOTS)).astype(np.int64)
        miss = np.flatnonzero(self.keys[slot] != key)
        found = self.values[slot]
        if len(miss):
            new, back = np.unique(key[miss], return_inverse=True)
            value = np.array([self.change(k >> 8, k & 255) for k in new.tolist()], np.int64)
            found[miss] = value[back]
            self.keys[slot[miss]], self.values[slot[miss]] = key[miss], found[miss]
        return found

    def read(self, data: bytes, starts: np.ndarray, state: int = 0) -> tuple[int, int]:
        """Count and exit state of bytes read one by one from an entry state; ``starts`` are the places of word starts."""
        total, table = 0, self.table
        cuts = [0, *(p for p in starts.tolist() if p), len(data)]
        if len(starts) and starts[0] == 0:
            state = 0
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a:
                state = 0
            for x in data[a:b]:
                if (found := table.get(state << 8 | x)) is None:
                    found = self.compile(state, x)
                state = found >> 12
                total += (found & 4095) - 2048
        return total, state

    def count_strings(self, strings: list[str]) -> np.ndarray:
        """Tokens of each string, none of which has a special token; all chunks are read in step."""
        if len(self.table) > self.bound:
            self.reset()
        out = np.zeros(len(strings), np.int64)
        joined = "".join(strings)
        if not joined:
            return out
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        size = np.fromiter(map(len, strings), np.int64, len(strings))
        begin = (np.cumsum(size) - size)[size > 0]
        place = np.append(0, np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)))  # of characters, in bytes
        word = place[np.flatnonzero(word_starts(codes, begin))]
        first = np.zeros(len(data), bool)
        first[place[begin]] = True
        new = first[word]
        new[1:] |= (word[1:] // CHUNK) != (word[:-1] // CHUNK)
        lane = word[new]
        length = np.diff(np.append(lane, len(data)))
        owner = np.flatnonzero(size > 0)[np.searchsorted(place[begin], lane, "right") - 1]
        count = np.zeros(len(lane), np.int64)
        for i in np.flatnonzero(length > LONG).tolist():
            a, b = int(lane[i]), int(lane[i] + length[i])
            count[i] = self.read(data[a:b].tobytes(), word[np.searchsorted(word, a) : np.searchsorted(word, b)] - a)[0]
        is_word = np.zeros(len(data), bool)
        is_word[word] = True
        order = np.argsort(-np.where(length > LONG, 0, length), kind="stable")
        length = np.where(length > LONG, 0, length)[order]
        at, total, state = lane[order], np.zeros(len(lane), np.int64), np.zeros(len(lane), np.int64)
        live = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")  # chunks longer than t
        for t, k in enumerate(live.tolist()):
            here = at[:k] + t
            found = self.steps(np.where(is_word[here], 0, state[:k]), data[here].astype(np.int64))
            state[:k] = found >> 12
            total[:k] += (found & 4095) - 2048
        count[order] += total
        return np.bincount(owner, count, len(strings)).astype(np.int64)

    def plain(self, text: str) -> tuple[list[str], int]:
        """The text without special tokens, in strings, and how many of those there are."""
        parts = self.special.split(text) if self.special and "<" in text else [text]
        return parts, len(parts) - 1

    def segments(self, text: str, size: int) -> Iterator[tuple[str, bool, bool]]:
        """A string in segments of about ``size`` characters, and whether each is open to the left and to the right."""
        at, left = 0, False
        while len(text) - at > size:
            ahead = text[at : at + size + 1]
            cut, inside = cut_at(ahead, size)
            if cut == len(ahead):  # no place to cut: very short segments only
                break
            yield ahead[:cut], left, inside
            at, left = at + cut, inside
        yield text[at:], left, False

    def run(self, text: str, state: int, left: bool) -> tuple[int, int]:
        """Count and exit state of a segment that is open to a side."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.append(0, np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF)))
        starts = place[np.flatnonzero(word_starts(codes, np.zeros(1, np.int64), left))]
        return self.read(text.encode("utf-8", "surrogatepass"), starts, state)

    def read_open(self, text: str, state: int, left: bool, right: bool, window: int) -> tuple[int, int]:
        """Count and exit state of a string that may be open to a side, a window at a time."""
        total = 0
        pieces = list(self.segments(text, window))
        for i, (piece, open_left, open_right) in enumerate(pieces):
            open_left, open_right = open_left or left and not i, open_right or right and i == len(pieces) - 1
            if open_left or open_right:
                n, state = self.run(piece, state if open_left else 0, open_left)
            else:
                n, state = int(self.count_strings([piece])[0]), 0
            total += n
        return total, state

    def count(self, text: str, window: int = WINDOW) -> int:
        """Tokens of a whole text in order."""
        parts, total = self.plain(text)
        return total + sum(self.read_open(p, 0, False, False, window)[0] for p in parts)

    def count_all(self, texts: list[str | None], window: int = WINDOW) -> np.ndarray:
        """Tokens of every text."""
        out = np.zeros(len(texts), np.int64)
        held: list[str] = []
        owner: list[int] = []
        size = 0

        def close() -> None:
            nonlocal size
            np.add.at(out, owner, self.count_strings(held))
            held.clear(), owner.clear()
            size = 0

        for i, text in enumerate(texts):
            if not text:
                continue
            if len(text) > window:
                out[i] = self.count(text, window)
                continue
            parts, n = self.plain(text)
            out[i] += n
            if size + len(text) > window and held:
                close()
            held += parts
            owner += [i] * len(parts)
            size += len(text)
        if held:
            close()
        return out

    # States by name, the same in every worker.

    def name_of(self, state: int) -> str:
        return repr(self.keys_of[state])

    def lead_state(self, lead: str) -> int:
        """The state after the characters before an open segment, all of one run."""
        return self.read(lead.encode("utf-8", "surrogatepass"), np.zeros(0, np.int64))[1]


_COMPILED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """One transducer for each Python worker, for all its tasks."""
    if path not in _COMPILED:
        _COMPILED[path] = Transducer(path)
    return _COMPILED[path]


_MAP = "doc_id {0}, n_bytes long, row long, string int, segment int, entry string, exit string, count long"


def _cut(path: str, split: int):
    """Long texts as segments of their strings between special tokens, with what stands before an open one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            for i, text in enumerate(batch.column(2)):
                parts, special = machine.plain(text.as_py())
                for k, part in enumerate(parts):
                    lead = ""
                    for j, (piece, left, right) in enumerate(machine.segments(part, split)):
                        one = [batch.column(c).slice(i, 1) for c in (0, 1, 3)]
                        rest = [pa.array([k], pa.int32()), pa.array([j], pa.int32()), pa.array([lead if left else ""]), pa.array([piece]), pa.array([left]), pa.array([right]), pa.array([special if not k and not j else 0], pa.int64())]
                        yield pa.RecordBatch.from_arrays([*one, *rest], names=["doc_id", "n_bytes", "row", "string", "segment", "lead", "text", "left", "right", "special"])
                        lead = piece[-LONG:]

    return run


def _map_segments(path: str, window: int):
    """Each segment's map: entry state, exit state, count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            for i, r in enumerate(batch.select(["lead", "text", "left", "right", "special"]).to_pylist()):
                if len(machine.table) > machine.bound:
                    machine.reset()
                entry = state = machine.lead_state(r["lead"]) if r["left"] else 0
                entry_name, total = machine.name_of(entry), r["special"]
                count, state = machine.read_open(r["text"], state, r["left"], r["right"], window)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in range(5)), pa.array([entry_name]), pa.array([machine.name_of(state)]), pa.array([total + count], pa.int64())], names=["doc_id", "n_bytes", "row", "string", "segment", "entry", "exit", "count"])

    return run


def _compose(maps: list[tuple[str, str, int]]) -> tuple[str, str, int] | None:
    """The map of neighbouring segments by doubling, as in a prefix scan; None where an exit is not the next entry."""
    while len(maps) > 1:
        pairs = [maps[i : i + 2] for i in range(0, len(maps), 2)]
        if any(len(p) > 1 and p[0][1] != p[1][0] for p in pairs):
            return None
        maps = [(p[0][0], p[-1][1], sum(x[2] for x in p)) for p in pairs]
    return maps[0]


def _join(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
    """A text's count from its segments' maps; null if they do not compose."""
    rows = sorted(t.select(["string", "segment", "entry", "exit", "count"]).to_pylist(), key=lambda r: (r["string"], r["segment"]))
    strings: dict[int, list] = {}
    for r in rows:
        strings.setdefault(r["string"], []).append((r["entry"], r["exit"], r["count"]))
    whole = [_compose(m) for m in strings.values()]
    return pa.table({"row": [key[0]], "doc_id": t["doc_id"].slice(0, 1), "n_bytes": t["n_bytes"].slice(0, 1), "n_tokens": pa.array([None if None in whole else sum(w[2] for w in whole)], pa.int64())})


def count_tokens(documents: DataFrame, path: str | None = None, limit: int = 1024, split: int = SPLIT, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row's whole text; texts over ``split`` characters are dealt over tasks."""
    path = path or public_tokenizers.path("byte_bpe_50k.json")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            n = machine.count_all(batch.column(2).to_pylist(), window)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    schema = f"doc_id {kind}, n_bytes long, n_tokens long"
    long = F.coalesce(F.length("text") > split, F.lit(False))
    if not rows.agg(F.max(long)).first()[0]:
        return rows.mapInArrow(whole, schema).withColumn("over_limit", F.col("n_tokens") > limit)
    spark = documents.sparkSession
    texts = stage(rows.where(long).withColumn("row", F.monotonically_increasing_id()), "token-texts")
    cut = texts.mapInArrow(_cut(path, split), f"doc_id {kind}, n_bytes long, row long, string int, segment int, lead string, text string, left boolean, right boolean, special long")
    maps = cut.repartition(shuffle_width(spark), "row", "string", "segment").mapInArrow(_map_segments(path, window), _MAP.format(kind))
    joined = stage(maps.groupBy("row").applyInArrow(_join, f"row long, doc_id {kind}, n_bytes long, n_tokens long"), "token-maps")
    # Texts whose maps did not compose are read in order.
    again = texts.join(joined.where("n_tokens IS NULL").select("row"), "row", "left_semi").select("doc_id", "n_bytes", "text").mapInArrow(whole, schema)
    found = rows.where(~long).mapInArrow(whole, schema).unionByName(joined.where("n_tokens IS NOT NULL").drop("row")).unionByName(again)
    return found.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
