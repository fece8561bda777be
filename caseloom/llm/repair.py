"""Conversations brought back to the form of a dialogue by cheapest edits, found over a grammar of their role and fault sequences.

Every row is one of nine symbols (role initial, whole or truncated; or to be deleted). Re-Pair replaces the most frequent pair
of symbols by a rule until none repeats. A symbol has a min-plus transfer matrix over the four states of the wanted form
``(s?(ua)+)?``, each entry a cost and an audit (its edits as a rope); a rule's matrix is the product of its two parts, made once
and used for all conversations of a task. Edits of equal cost over the same rows are never prefixes of each other (one letter
per row, and every further letter costs), so the least audit of a product comes from the least audits of its parts.

Long conversations span several parts of a range-partitioned table: a part's matrix is then combined with the next.
"""

from __future__ import annotations

import hashlib
import heapq

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
STATES = 4  # nothing yet, after system, after user, after assistant
_LEGAL = {"su", "ua", "au"}
_LEAF = 24
_BASE, _PRIME = 0x2545F4914F6CDD1D % ((1 << 61) - 1), (1 << 61) - 1
_MOST = (1 << 63) - 1


class Rope:
    """A string as a tree that shares its parts; a hash of the whole makes equal parts easy to skip."""

    __slots__ = ("hash", "left", "right", "size", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if text is not None:
            self.size, self.hash = len(text), 0
            for c in text:
                self.hash = (self.hash * _BASE + ord(c)) % _PRIME
        else:
            self.size = left.size + right.size
            self.hash = (left.hash * pow(_BASE, right.size, _PRIME) + right.hash) % _PRIME

    def __add__(self, other: Rope) -> Rope:
        if not other.size:
            return self
        if not self.size:
            return other
        if self.size + other.size <= _LEAF and self.text is not None and other.text is not None:
            return Rope(self.text + other.text)
        return Rope(None, self, other)

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.text is not None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)

    def __lt__(self, other: Rope) -> bool:
        if self.text is not None and other.text is not None:
            return self.text < other.text
        mine, its = [self], [other]
        while mine and its:
            x, y = mine.pop(), its.pop()
            if x.size == y.size and x.hash == y.hash:
                continue
            if x.text is None and (y.text is not None or x.size >= y.size):
                mine += [x.right, x.left]
                its.append(y)
            elif y.text is None:
                its += [y.right, y.left]
                mine.append(x)
            else:
                n = min(x.size, y.size)
                if x.text[:n] != y.text[:n]:
                    return x.text < y.text
                mine += [Rope(x.text[n:])] if x.size > n else []
                its += [Rope(y.text[n:])] if y.size > n else []
        return bool(its)


Entry = tuple[int, Rope] | None
EMPTY = Rope("")


def better(a: Entry, b: Entry) -> Entry:
    if a is None or b is None:
        return a or b
    return a if a[0] < b[0] or (a[0] == b[0] and not b[1] < a[1]) else b


def product(rows: list[list[Entry]], matrix: list[list[Entry]]) -> list[list[Entry]]:
    out = []
    for row in rows:
        line: list[Entry] = [None] * STATES
        for x, after in zip(row, matrix):
            if x is not None:
                for q, y in enumerate(after):
                    if y is not None and (line[q] is None or x[0] + y[0] <= line[q][0]):
                        line[q] = better(line[q], (x[0] + y[0], x[1] + y[1]))
        out.append(line)
    return out


IDENTITY: list[list[Entry]] = [[(0, EMPTY) if p == q else None for q in range(STATES)] for p in range(STATES)]
#: after a state: what comes next, a user's turn or an assistant's
_NEXT = ["user", "user", "assistant", "user"]
_AFTER = {"s": 1, "u": 2, "a": 3}
_INSERT = [[((2 * n, Rope("I" * n)) if (n := {(0, 2): 1, (0, 3): 2, (1, 2): 1, (1, 3): 2, (2, 3): 1, (3, 2): 1}.get((p, q), 0 if p == q else -1)) >= 0 else None)
            for q in range(STATES)] for p in range(STATES)]
#: symbol of a row that must go
DELETED = 0


def _row_matrix(initial: str | None, truncated: bool) -> list[list[Entry]]:
    """Edits of one row, inserts before it included; without an initial the row must go."""
    edit: list[list[Entry]] = [[(3, Rope("D")) if p == q else None for q in range(STATES)] for p in range(STATES)]
    if initial is not None:
        for p in range(STATES):
            q = _AFTER[_NEXT[p][0]]
            edit[p][q] = better(edit[p][q], (2 + truncated, Rope("R")))
            if initial == _NEXT[p][0] or (initial == "s" and p == 0):
                edit[p][_AFTER[initial]] = better(edit[p][_AFTER[initial]], (int(truncated), Rope("K")))
    return product(_INSERT, edit)


class Grammar:
    """Rules found so far in a task, with the matrix of every symbol."""

    def __init__(self):
        kinds = [(c, t) for c in "sua?" for t in (False, True)]
        self.number = {x: i for i, x in enumerate(kinds, 1)}
        self.matrix = [_row_matrix(None, False), *[_row_matrix(c, t) for c, t in kinds]]
        self.rules: dict[tuple[int, int], int] = {}

    def symbol(self, initial: str, truncated: bool) -> int:
        return self.number[initial if initial in _AFTER else "?", truncated]

    def rule(self, a: int, b: int) -> int:
        if (a, b) not in self.rules:
            self.rules[a, b] = len(self.matrix)
            self.matrix.append(product(self.matrix[a], self.matrix[b]))
        return self.rules[a, b]

    def compress(self, sequences: list[list[int]]) -> list[list[int]]:
        """Re-Pair over all sequences: the most frequent pair of neighbours becomes one symbol, as long as a pair stands twice."""
        symbol = [x for s in sequences for x in s]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        at = 0
        for s in sequences:
            if s:
                before[at] = -1
                at += len(s)
                after[at - 1] = -1
        where: dict[tuple[int, int], list[int]] = {}
        for i, j in enumerate(after):
            if j >= 0:
                where.setdefault((symbol[i], symbol[j]), []).append(i)
        heap = [(-len(w), pair) for pair, w in where.items() if len(w) > 1]
        heapq.heapify(heap)
        while heap:
            count, pair = heapq.heappop(heap)
            a, b = pair
            places, taken = [], -1
            for i in sorted(set(where.get(pair, ()))):
                if symbol[i] == a and after[i] >= 0 and symbol[after[i]] == b and i != taken:
                    places.append(i)
                    taken = after[i]  # in a run of equal symbols a place is used once
            if len(places) < -count:
                where[pair] = places
                if len(places) > 1:
                    heapq.heappush(heap, (-len(places), pair))
                continue
            del where[pair]
            new, touched = self.rule(a, b), set()
            for i in places:
                j = after[i]
                symbol[i], symbol[j] = new, -1
                k = after[i] = after[j]
                if k >= 0:
                    before[k] = i
                    where.setdefault((new, symbol[k]), []).append(i)
                    touched.add((new, symbol[k]))
                h = before[i]
                if h >= 0:
                    where.setdefault((symbol[h], new), []).append(h)
                    touched.add((symbol[h], new))
            for pair in touched:
                if len(where[pair]) > 1:
                    heapq.heappush(heap, (-len(where[pair]), pair))
        out, at = [], 0
        for s in sequences:
            out.append([x for x in symbol[at:at + len(s)] if x >= 0])
            at += len(s)
        return out

    def over(self, sequence: list[int], rows: list[list[Entry]]) -> list[list[Entry]]:
        for x in sequence:
            rows = product(rows, self.matrix[x])
        return rows


def ended(row: list[Entry]) -> tuple[int, str]:
    """The best end of a conversation from the entries of its states."""
    line = product([row], _INSERT)[0]
    cost, audit = better(line[0], line[3])
    return cost, str(audit)


_SEGMENT = ("place bigint, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
            "turns bigint, least bigint, most bigint, cost array<bigint>, audit array<string>")


def _segments(batches):
    """Runs of one conversation in a batch of sorted rows: counts, and the cost and audit of each pair of states (one, where
    the run is surely the whole conversation)."""
    grammar, number = Grammar(), TaskContext.get().partitionId() << 32
    for batch in batches:
        rows = list(zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "initial", "fault", "n", "repeated"))))
        cuts = [i for i in range(len(rows)) if not i or rows[i][0] != rows[i - 1][0]] + [len(rows)]
        out, sequences = [], []
        for low, high in zip(cuts, cuts[1:]):
            x = {"place": number, "n": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "least": None, "most": None,
                 "first": rows[low][2], "last": rows[high - 1][2]}
            sequence, last = [], None
            for i in range(low, high):
                _, turn, initial, fault, n, repeated = rows[i]
                x["n"] += n
                x["illegal"] += (n - 1) * (initial + initial not in _LEGAL) + (last is not None and last + initial not in _LEGAL)
                last = initial
                if turn is not None and turn != x["most"]:
                    x["turns"] += 1
                    x["least"], x["most"] = turn if x["least"] is None else x["least"], turn
                lost = n if fault == "blank" or repeated else n - 1
                x["blank" if fault == "blank" else "duplicate"] += lost
                if lost < n:
                    x["truncated"] += fault == "truncated"
                    sequence.append(grammar.symbol(initial, fault == "truncated"))
                sequence += [DELETED] * lost
            out.append(x)
            sequences.append(sequence)
        known: dict[tuple[int, ...], tuple[int, str]] = {}
        for i, (x, sequence) in enumerate(zip(out, grammar.compress(sequences))):
            if 0 < i < len(out) - 1:
                key = tuple(sequence)
                if key not in known:
                    known[key] = ended(grammar.over(sequence, IDENTITY[:1])[0])
                x["cost"], x["audit"] = [known[key][0]], [known[key][1]]
            else:
                entries = [e for line in grammar.over(sequence, IDENTITY) for e in line]
                x["cost"], x["audit"] = [-1 if e is None else e[0] for e in entries], ["" if e is None else str(e[1]) for e in entries]
        number += 1
        if out:
            yield pa.RecordBatch.from_arrays([batch["conv_id"].take(pa.array(cuts[:-1])), pa.array(out, _SEGMENT_ARROW)], ["conv_id", "segment"])


_KINDS = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
_SEGMENT_ARROW = pa.struct([(c.split()[0], _KINDS[c.split()[1]]) for c in _SEGMENT.split(", ")])
_OUT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


class _Conversation:
    """One conversation while its segments, and then its rows, pass by in order."""

    def __init__(self, conv_id):
        self.conv_id, self.segments, self.audit = conv_id, [], None
        self.sha, self.begun, self.state, self.at = hashlib.sha256(), False, 0, 0

    def settle(self) -> None:
        """Combines the segments."""
        s = self.segments
        self.cost, self.audit = 0, ""
        if len(s) == 1 and len(s[0]["cost"]) == 1:
            self.cost, self.audit = s[0]["cost"][0], s[0]["audit"][0]
        elif s:
            rows = IDENTITY[:1]
            for x in s:
                entries = [None if c < 0 else (c, Rope(a)) for c, a in zip(x["cost"], x["audit"])]
                rows = product(rows, [entries[p * STATES:(p + 1) * STATES] for p in range(STATES)])
            self.cost, self.audit = ended(rows[0])
        self.total = {k: sum(x[k] for x in s) for k in ("blank", "duplicate", "truncated", "illegal")}
        self.total["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(s, s[1:]))
        turns = [x for x in s if x["least"] is not None]
        distinct = sum(x["turns"] for x in turns) - sum(a["most"] == b["least"] for a, b in zip(turns, turns[1:]))
        self.gaps = min(_MOST, turns[-1]["most"] - turns[0]["least"] + 1 - distinct) if turns else 0

    def _write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.begun else "") + role + ":" + text).encode())
        self.begun = True
        self.state = _AFTER[role[0]]

    def _inserts(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._write(_NEXT[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._write(role if edit == "K" else _NEXT[self.state], text)

    def result(self) -> tuple:
        if self.audit is None:
            self.settle()
        self._inserts()
        t = self.total
        return self.conv_id, self.gaps, t["blank"], t["duplicate"], t["truncated"], t["illegal"], self.cost, self.audit, self.sha.hexdigest()


def _repaired(batches):
    """Segments and rows of whole conversations in order; texts are hashed as they pass, none is kept."""
    now, names = None, [c.split()[0] for c in _OUT.split(", ")]
    types = [_KINDS[c.split()[1]] for c in _OUT.split(", ")]
    batch_of = lambda done: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
    for batch in batches:
        done = []
        for conv_id, segment, role, text, copies in zip(*(batch[c].to_pylist() for c in ("conv_id", "segment", "role", "text", "copies"))):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv_id)
            if segment is not None:
                now.segments.append(segment)
                continue
            if now.audit is None:
                now.settle()
            for _ in range(copies):
                now.row(role, text)
        if done:
            yield batch_of(done)
    if now is not None:
        yield batch_of([now.result()])


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with planted faults, by CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops the row (0 copies), 1 empties its text, 2 takes . ! ? out, 3 gives 2 copies, 4 makes it the user's. A null role or text,
    and a null id or turn within the key, is one space; ``conv_id`` and ``turn`` themselves stay null.
    """
    blank = F.lit(" ")
    rows = conversations.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                                F.coalesce(F.col(role), blank).alias("role"), F.coalesce(F.col(text), blank).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = rows.withColumn("damage", F.crc32(key.cast("binary")) % 20)
    return rows.select("conv_id", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                       F.when(F.col("damage") == 0, 0).when(F.col("damage") == 3, 2).otherwise(1).alias("copies"))


def repaired(rows: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text, copies): gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows go by turn (null first), those of one turn by role, then by a digest of role and text; ``copies`` rows stand side by side,
    and a conversation whose rows all have 0 copies gives zeros and the digest of an empty string. The first fault of a row counts:
    blank, duplicate (role and text of an earlier row), truncated. A null id is a conversation of its own. An empty role has no
    initial and fits no place. Gaps beyond a long are cut to the largest long. An empty table gives no rows. A conversation's rows
    pass through one task, in order and without being kept, because its digest is one stream.
    """
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256))
    rows = rows.withColumn("digest", digest)
    left = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(left == "", "blank").when(~F.substring(left, -1, 1).isin(".", "!", "?"), "truncated").otherwise("whole")
    slim = rows.where("copies > 0").select("conv_id", "turn", "role", "digest", fault.alias("fault"), "copies")
    slim = slim.groupBy("conv_id", "turn", "role", "digest", "fault").agg(F.sum("copies").alias("n"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = slim.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(when).alias("earliest"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    slim = slim.join(again, slim["conv_id"].eqNullSafe(again["c"]) & (slim["digest"] == again["d"]), "left")
    repeated = F.col("earliest").isNotNull() & ~F.col("earliest").eqNullSafe(when)
    slim = slim.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "fault", "n", repeated.alias("repeated"))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    slim = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    segments = slim.select("conv_id", "turn", "initial", "fault", "n", "repeated").mapInArrow(_segments, f"conv_id bigint, segment struct<{_SEGMENT.replace(' ', ': ').replace(',:', ',')}>")
    none = F.lit(None)
    both = segments.select("conv_id", "segment", none.cast("bigint").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("digest"),
                           none.cast("string").alias("text"), F.lit(0).alias("copies"))
    both = both.unionAll(rows.select("conv_id", none.cast(both.schema["segment"].dataType).alias("segment"), "turn", "role", "digest", "text", "copies"))
    both = both.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_last("segment.place"), *order[1:])
    return both.select("conv_id", "segment", "role", "text", "copies").mapInArrow(_repaired, _OUT)
