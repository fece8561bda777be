"""Rule-based extraction from free text, device JSON and syslog lines.

Rules are data. Each compiles to column expressions over the lower-cased text, so a whole extraction is a stack of
projections without a shuffle and without Python in the tasks. What several output columns share (the phrases that
occur in a section, the items marked yes) is a helper column that reads the record once, however many phrases or items
there are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.scalar import total
from caseloom.operators.profile import missing_counts
from caseloom.operators.reshape import union_all

LEFT = r"(?<![\p{L}\p{N}_])"
RIGHT = r"(?![\p{L}\p{N}_])"


def word(pattern: str) -> str:
    """The pattern as a whole word; letters of every script count as word characters."""
    return f"{LEFT}(?:{pattern}){RIGHT}"


def any_of(phrases: Sequence[str]) -> str:
    """A regex that matches one of the literal phrases, the longest one at a position; common beginnings are shared."""
    tree: dict = {}
    for phrase in phrases:
        node = tree
        for letter in phrase:
            node = node.setdefault(letter, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        branches = [re.escape(letter) + pattern(rest) for letter, rest in node.items() if letter]
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 and "" not in node else "(?:" + "|".join(branches) + ")"
        return body + ("?" if "" in node else "")
    return pattern(tree)


def mentioned(text: Column, phrases: Sequence[str], within: str = "") -> Column:
    """The phrases that start anywhere in the text (overlaps included), as an array, found in one pass.

    Of phrases that start at the same place only the longest is listed; ``among`` knows that it implies the others.
    ``within`` is a regex for what is listed together with the phrase that it follows.
    """
    return F.regexp_extract_all(text, F.lit(f"(?=({any_of(phrases)}{within}))"), F.lit(1))


def among(found: str, phrases: Sequence[str], known: Sequence[str]) -> Column:
    """Whether one of the phrases is in a helper column made by ``mentioned`` from the ``known`` phrases."""
    implying = [k for k in dict.fromkeys(known) if any(k.startswith(p) for p in phrases)]
    return F.arrays_overlap(F.col(found), F.array(*[F.lit(p) for p in implying]))


class Rule:
    """A rule has helper columns over the text, and output columns over the text and the helpers."""

    def helpers(self, text: Column) -> dict[str, Column]:
        return {}


def split_records(df: DataFrame, text: str, delimiter: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per record of a text column cut at a delimiter regex; blank records are dropped.

    ``record_no`` is the position among all pieces of the text, from 1.
    """
    cut = df.select(*keep, F.posexplode(F.split(F.col(text), delimiter)).alias("_p", "_t"))
    clean = F.regexp_replace("_t", r"^\s+|\s+$", "")
    return cut.select(*keep, (F.col("_p") + 1).alias("record_no"), clean.alias("text")).where("text <> ''")


@dataclass(frozen=True)
class Number(Rule):
    """The first number that a pattern finds; the first group that took part in the match gives the digits."""

    name: str
    pattern: str
    groups: tuple[int, ...] = (1,)
    dtype: str = "int"

    def columns(self, text: Column) -> dict[str, Column]:
        return {self.name: F.coalesce(*[F.regexp_extract(text, self.pattern, g).try_cast(self.dtype) for g in self.groups])}


@dataclass(frozen=True)
class Choice(Rule):
    """The value of the first case whose pattern occurs, else the default."""

    name: str
    cases: tuple[tuple[str, object], ...]
    default: object = None

    def columns(self, text: Column) -> dict[str, Column]:
        branch = None
        for pattern, value in self.cases:
            hit = text.rlike(pattern)
            branch = F.when(hit, F.lit(value)) if branch is None else branch.when(hit, F.lit(value))
        return {self.name: branch.otherwise(F.lit(self.default))}


@dataclass(frozen=True)
class Polarity(Rule):
    """0 if a negative phrase occurs, else 1 if a positive one does, else a keyword without negation words."""

    name: str
    negative: str
    positive: str
    keyword: str | None = None
    negators: tuple[str, ...] = ()

    def columns(self, text: Column) -> dict[str, Column]:
        last = F.lit(0)
        if self.keyword:
            clear = text.contains(self.keyword) & ~text.rlike(any_of(self.negators))
            last = F.when(clear, 1).otherwise(0)
        return {self.name: F.when(text.rlike(self.negative), 0).when(text.rlike(self.positive), 1).otherwise(last)}


@dataclass(frozen=True)
class Captured(Rule):
    """A captured group, trimmed, mapped to its canonical spelling, with a default."""

    name: str
    patterns: tuple[tuple[str, int], ...]
    spelling: dict[str, object] = field(default_factory=dict)
    default: object = None

    def helpers(self, text: Column) -> dict[str, Column]:
        return {f"_{self.name}_{i}": F.trim(F.regexp_extract(text, p, g)) for i, (p, g) in enumerate(self.patterns)}

    def columns(self, text: Column) -> dict[str, Column]:
        raw = [F.col(f"_{self.name}_{i}") for i in range(len(self.patterns))]
        if self.spelling:
            names = F.create_map(*[F.lit(x) for pair in self.spelling.items() for x in pair])
            found = [names[r] for r in raw]
        else:
            found = [F.nullif(r, F.lit("")) for r in raw]
        return {self.name: F.coalesce(*found, *([] if self.default is None else [F.lit(self.default)]))}


@dataclass(frozen=True)
class Phrases(Rule):
    """Phrase dictionary flags: 1 if a positive phrase occurs, 0 if a negative one or none does."""

    flags: dict[str, tuple[Sequence[str], Sequence[str]]]

    @property
    def known(self) -> list[str]:
        return [p for yes, no in self.flags.values() for p in (*yes, *no)]

    def helpers(self, text: Column) -> dict[str, Column]:
        return {"_phrases": mentioned(text, self.known)}

    def columns(self, text: Column) -> dict[str, Column]:
        return {n: F.when(among("_phrases", yes, self.known), 1).when(among("_phrases", no, self.known), 0).otherwise(0)
                for n, (yes, no) in self.flags.items()}


@dataclass(frozen=True)
class Questionnaire(Rule):
    """Numbered yes/no items in any of five layouts.

    A list of endorsed items decides when there is one. Otherwise an item counts by its mark: ``a1(+)``, ``a1: yes``,
    ``a1 = 1``, or an item line that ends in the endorsement. Each layout is read for all items at once.
    """

    prefix: str
    count: int
    endorsed: str
    none_endorsed: str
    item_line: str
    score: str | None = None

    def helpers(self, text: Column) -> dict[str, Column]:
        item = rf"{LEFT}{self.prefix}(\d+)"

        def items(source: Column, pattern: str) -> Column:
            return F.regexp_extract_all(source, F.lit(pattern), F.lit(1))
        return {
            "_listed": text.rlike(self.endorsed),
            "_chosen": items(F.regexp_extract(text, self.endorsed, 1), item + RIGHT),
            "_none": text.rlike(self.none_endorsed),
            "_yes": items(text, rf"{item}(?:\s*\(\+\)|:\s*(?:yes|\+)|\s*=\s*1{RIGHT})"),
            "_no": items(text, rf"{item}(?:\s*\(-\)|:\s*(?:no{RIGHT}|-)|\s*=\s*0{RIGHT})"),
            "_lines": items(text, self.item_line.format(item=item)),
        }

    def columns(self, text: Column) -> dict[str, Column]:
        out = {}
        for i in range(1, self.count + 1):
            def has(c: str) -> Column:
                return F.array_contains(c, str(i))
            out[f"{self.prefix}{i}"] = (
                F.when(F.col("_listed"), has("_chosen").cast("int")).when(F.col("_none"), 0).when(has("_yes"), 1)
                .when(has("_no"), 0).otherwise(has("_lines").cast("int")))
        if self.score:
            out[self.score] = total([out[f"{self.prefix}{i}"] for i in range(1, self.count + 1)])
        return out


@dataclass(frozen=True)
class Symptoms(Rule):
    """Flags from synonyms. A marked synonym ``syn(+)`` / ``syn(-)`` decides; then the section of reported symptoms,
    then the denied ones; without any denial a mention anywhere counts."""

    synonyms: dict[str, Sequence[str]]
    reports: str
    denies: str
    blanket_denial: str

    @property
    def known(self) -> list[str]:
        return [w for words in self.synonyms.values() for w in words]

    def helpers(self, text: Column) -> dict[str, Column]:
        return {
            # "syn", "syn(+)" and "syn(-)" come out of one pass over the record
            "_said": mentioned(text, self.known, within=r"(?:\([+-]\))?"),
            "_reported": mentioned(F.regexp_extract(text, self.reports, 1), self.known),
            "_denied": text.rlike(self.denies) | text.rlike(self.blanket_denial),
        }

    def columns(self, text: Column) -> dict[str, Column]:
        out = {}
        for name, words in self.synonyms.items():
            def marked(mark: str) -> Column:
                return F.arrays_overlap("_said", F.array(*[F.lit(w + mark) for w in words]))
            implying = [k for k in self.known if any(k.startswith(w) for w in words)]
            anywhere = F.arrays_overlap("_said", F.array(*[F.lit(k + m) for k in implying for m in ("", "(+)", "(-)")]))
            out[name] = (F.when(marked("(+)"), 1).when(marked("(-)"), 0).when(among("_reported", words, self.known), 1)
                         .when(F.col("_denied"), 0).when(anywhere, 1).otherwise(0))
        return out


@dataclass(frozen=True)
class Telemetry:
    """Age, sex, risk class and symptom codes from a device record, JSON or ``KEY=value`` syslog."""

    codes: dict[str, str]
    json_schema: str
    age: str = "age"
    sex: str = "sex"
    label: str = "label"

    @staticmethod
    def is_device(raw: Column) -> Column:
        return raw.contains("SYS_LOG") | (raw.contains("{") & raw.contains("telemetry"))

    @staticmethod
    def is_json(raw: Column) -> Column:
        return raw.contains("{") & raw.contains("}")

    def from_json(self, raw: Column) -> dict[str, Column]:
        data = F.from_json(F.regexp_extract(raw, r"(?s)(\{.*\})", 1), self.json_schema)
        flags = data["telemetry"]["symptoms_flagged"]
        out = {self.age: data["patient"]["age"], self.sex: F.when(data["patient"]["gender"] == "M", 1).otherwise(0),
               self.label: F.when(data["telemetry"]["risk_classification"] == "HIGH", 1).otherwise(0)}
        return out | {n: F.when(F.array_contains(flags, code), 1).otherwise(0) for n, code in self.codes.items()}

    def from_syslog(self, raw: Column) -> dict[str, Column]:
        def value(pattern: str) -> Column:
            return F.nullif(F.regexp_extract(raw, pattern, 1), F.lit(""))
        flags = F.split(value(r"SYMPT_FLAG=([A-Z_,]+)"), ",")
        out = {self.age: value(r"PT_AGE=(\d+)").try_cast("int"),
               self.sex: F.when(value("GENDER=(M|F)") == "M", 1).when(value("GENDER=(M|F)") == "F", 0),
               self.label: F.when(value("RISK_CLASS=(HIGH|LOW)") == "HIGH", 1).when(value("RISK_CLASS=(HIGH|LOW)") == "LOW", 0)}
        return out | {n: F.when(F.array_contains(flags, code), 1).otherwise(0) for n, code in self.codes.items()}


def rule_columns(rules: Sequence[Rule], text: Column) -> dict[str, Column]:
    out: dict[str, Column] = {}
    for rule in rules:
        out.update(rule.columns(text))
    return out


def with_helpers(df: DataFrame, rules: Sequence[Rule], text: Column) -> DataFrame:
    made: dict[str, Column] = {}
    for rule in rules:
        made.update(rule.helpers(text))
    return df.withColumns(made) if made else df


def extract(df: DataFrame, rules: Sequence[Rule], text: str = "text", keep: Sequence[str] = (), types: dict[str, str] | None = None,
            normalise=F.lower) -> DataFrame:
    """Applies rules to the normalised text and casts the results."""
    ready = with_helpers(df.select(*keep, normalise(F.col(text)).alias("_t")), rules, F.col("_t"))
    return cast_result(ready.select(*keep, *[c.alias(n) for n, c in rule_columns(rules, F.col("_t")).items()]), types)


def cast_result(df: DataFrame, types: dict[str, str] | None) -> DataFrame:
    types = types or {}
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def extract_routed(df: DataFrame, prose: Sequence[Rule], device: Telemetry, columns: Sequence[str], text: str = "text",
                   keep: Sequence[str] = (), types: dict[str, str] | None = None) -> DataFrame:
    """Routes each record by its format (JSON, syslog, prose) and extracts the same columns from all of them.

    A record of one format costs nothing in the branches of the others: their text is NULL there.
    """
    is_device, is_json = Telemetry.is_device(F.col(text)), Telemetry.is_json(F.col(text))
    raw = df.select(*keep, F.when(is_device & is_json, F.col(text)).alias("_json"), F.when(is_device & ~is_json, F.col(text)).alias("_log"),
                    F.when(~is_device, F.lower(text)).alias("_t"))
    parsed = with_helpers(raw, prose, F.col("_t")).withColumns(
        {"_j": F.struct(*[c.alias(n) for n, c in device.from_json(F.col("_json")).items()]),
         "_l": F.struct(*[c.alias(n) for n, c in device.from_syslog(F.col("_log")).items()])})
    from_prose = rule_columns(prose, F.col("_t"))
    return cast_result(parsed.select(*keep, *[
        F.when(F.col("_json").isNotNull(), F.col(f"_j.{c}")).when(F.col("_log").isNotNull(), F.col(f"_l.{c}")).otherwise(from_prose[c]).alias(c)
        for c in columns]), types)


def extraction_coverage(sources: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Records in, rows out and NULLs per extracted column, per source. The text is read once; records are counted without it."""
    parts = []
    for name, (records, rows) in sources.items():
        n_in = records.agg(F.count(F.lit(1))).scalar()
        parts.append(missing_counts(rows).select(
            F.lit(name).alias("source"), n_in.alias("records_in"), F.col("_rows").alias("rows_out"), "column_name", "missing"))
    return union_all(parts)
