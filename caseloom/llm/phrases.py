"""Word phrases that occur often and stick together, mined set by set over stored occurrence relations (SETM).

An occurrence relation holds (position, group) in text order: a group is one phrase of k words, and positions skip one
number between pieces, so that two occurrences can only meet inside a piece. Every block of documents has its own part of
the relation, in one row of a Parquet table that is bucketed by block, so occurrences are never shuffled. Length by length,
neighbours at adjacent positions are merge-joined, groups are counted over all blocks, and a semi-join with the frequent groups
leaves what the next length starts from. Blocks meet by 40-bit keys of their groups, in the order of the keys, so that shuffled rows
compress: keys only choose what stays (groups of one key stay together); the counts themselves are taken over the phrases.
"""

from __future__ import annotations

import gc
import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseloom.llm.arrays import RangeHash, Words, byte_class, flat_text, mix, one_array, pack, pieces, unpack
from caseloom.llm.blocks import text_bytes
from caseloom.session import shared_dir

BLOCK_BYTES = 5 << 20
_BREAKS = byte_class([(0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"]])
_IS_WORD = ~(_BREAKS | byte_class([(0x09, 0x09), (0x20, 0x20)]))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STATE = "block bigint, occurrences bigint, state binary"
_KINDS = (np.uint8, np.uint8, np.int32, np.int32, np.int32, np.uint8, np.uint8)
BLOCKS_IN_BUCKET = 5


def _planes(values: np.ndarray) -> np.ndarray:
    """Bytes of 32-bit values, the lowest of all first: planes of small numbers compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).ravel()


def _joined(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


class Relation:
    """Occurrences of one block: ``at`` ascending, ``group`` of each, ``words`` (groups x k, numbers in ``vocabulary``) and
    ``lang`` of each group (a number in ``langs``)."""

    def __init__(self, at, group, words, lang, vocabulary: pa.Array, langs: list[str]):
        self.at, self.group, self.words, self.lang, self.vocabulary, self.langs = at, group, words, lang, vocabulary, langs

    @classmethod
    def of(cls, table: pa.Table) -> tuple[Relation, dict[str, int]]:
        """Single words of the documents of a block, and the number of words of each language."""
        label = one_array(pc.fill_null(one_array(table["lang"]), "und")).dictionary_encode()
        langs = label.dictionary.to_pylist()
        data, offsets = flat_text(table["text"])
        words = Words(data, offsets, _IS_WORD)
        n = len(words.start)
        document = words.document()
        lang = label.indices.to_numpy(zero_copy_only=False)[document] if n else np.zeros(0, np.int64)
        seen = np.concatenate([[0], np.cumsum(_BREAKS[data], dtype=np.int32)])
        apart = (seen[words.start[1:]] > seen[words.end[:-1]]) | (document[1:] != document[:-1]) if n else np.zeros(0, bool)
        at = np.arange(n, dtype=np.int64)
        at[1:] += np.cumsum(apart)
        ends = np.concatenate([[0], np.cumsum(words.end - words.start)])
        flat = pa.LargeStringArray.from_buffers(n, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(_LOWER[data[_IS_WORD[data]]]))
        del seen, ends, data
        coded = flat.dictionary_encode()
        pair = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(langs) + lang
        found, group = np.unique(pair, return_inverse=True)
        out = cls(at, group.astype(np.int32), (found // max(1, len(langs))).astype(np.int32)[:, None], (found % max(1, len(langs))).astype(np.int32),
                  coded.dictionary, langs)
        return out, dict(zip(langs, np.bincount(lang, minlength=len(langs)).tolist()))

    def longer(self) -> Relation:
        """Merge-join by piece and adjacent position: phrases of one more word, where both shorter phrases occur."""
        first = np.flatnonzero(np.diff(self.at) == 1)
        pair = self.group[first].astype(np.int64) * max(1, len(self.words)) + self.group[first + 1]
        found, group = np.unique(pair, return_inverse=True)
        a, b = found // max(1, len(self.words)), found % max(1, len(self.words))
        return Relation(self.at[first], group.astype(np.int32), np.hstack([self.words[a], self.words[b][:, -1:]]), self.lang[a], self.vocabulary, self.langs)

    def counts(self) -> np.ndarray:
        return np.bincount(self.group, minlength=len(self.words))

    def keys(self) -> np.ndarray:
        """40-bit keys of the groups, the same in every block; the high bytes are zero, so that a shuffled row is shorter."""
        data, offsets = flat_text(self.vocabulary)
        word = RangeHash(data).of(offsets[:-1], offsets[1:])
        salt = np.array([int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in self.langs] or [0], np.uint64)
        key = salt[self.lang]
        for j in range(self.words.shape[1]):
            key = mix((key ^ word[self.words[:, j]]) * np.uint64(0x9FB21C651E98DF25))
        return (key >> np.uint64(24)).view(np.int64)

    def semi_join(self, keys: np.ndarray) -> Relation:
        """Occurrences of the groups whose key is among ``keys``; words that no group needs leave the vocabulary."""
        stays = np.isin(self.keys(), keys)
        number = np.cumsum(stays) - 1
        rows = stays[self.group]
        used, words = np.unique(self.words[stays], return_inverse=True)
        return Relation(self.at[rows], number[self.group[rows]].astype(np.int32), words.reshape(-1, self.words.shape[1]).astype(np.int32),
                        self.lang[stays], self.vocabulary.take(pa.array(used, pa.int64())), self.langs)

    def phrases(self) -> pa.Array:
        vocabulary = self.vocabulary.cast(pa.large_string())
        parts = [vocabulary.take(pa.array(self.words[:, j], pa.int64())) for j in range(self.words.shape[1])]
        return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))

    def packed(self) -> bytes:
        """One string; groups are numbered by falling count."""
        data, offsets = flat_text(self.vocabulary)
        shape = np.array([self.words.shape[1]], np.int32)
        langs = np.frombuffer(json.dumps(self.langs).encode(), np.uint8)
        order = np.argsort(-self.counts(), kind="stable")
        number = np.empty(len(order), np.int32)
        number[order] = np.arange(len(order), dtype=np.int32)
        return pack(_planes(np.diff(self.at, prepend=0)), _planes(number[self.group]), np.concatenate([shape, self.words[order].ravel()]), self.lang[order],
                    np.diff(offsets).astype(np.int32), data, langs)

    @classmethod
    def unpacked(cls, blob: bytes) -> Relation:
        step, group, words, lang, sizes, data, langs = unpack(blob, *_KINDS)
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        vocabulary = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data))
        return cls(np.cumsum(_joined(step), dtype=np.int64), _joined(group).astype(np.int32), words[1:].reshape(-1, int(words[0])), lang, vocabulary, json.loads(langs.tobytes()))


def _written(rows: DataFrame, name: str) -> DataFrame:
    path = shared_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _bucketed(rows: DataFrame, name: str, buckets: int) -> str:
    """Writes ``rows`` as a table in the shared folder, bucketed by block: a task writes a file for each bucket that it has rows of."""
    path = shared_dir(rows.sparkSession, name)
    rows.write.bucketBy(buckets, "block").sortBy("block").option("path", path).saveAsTable(_name(path), format="parquet")
    return path


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1].replace("-", "_")


def _dropped(spark, path: str) -> None:
    """Frees a relation that the next, already written one replaces, and lets Spark clear the shuffle files of finished plans."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    gc.collect()
    spark._jvm.java.lang.System.gc()


def _blocks(block_bytes: int):
    def run(batches):
        base, number = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for piece in pieces(batch, "text", block_bytes):
                relation, totals = Relation.of(piece)
                yield pa.RecordBatch.from_pydict(
                    {"block": [base + number], "occurrences": [len(relation.at)], "state": [relation.packed()], "langs": [list(totals)],
                     "n": [list(totals.values())]}, schema=pa.schema([("block", pa.int64()), ("occurrences", pa.int64()), ("state", pa.binary()),
                                                                      ("langs", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))]))
                number += 1
                del relation
                pa.default_memory_pool().release_unused()
    return run


def _group_counts(longer: bool):
    """(block, key, f) of the groups of each block, in the order of the keys: the next length, or the words themselves."""
    def run(batches):
        for batch in batches:
            for block, blob in zip(batch["block"].to_pylist(), batch["state"]):
                relation = Relation.unpacked(blob.as_py())
                relation = relation.longer() if longer else relation
                keys = relation.keys()
                order = np.argsort(keys)
                table = pa.table({"block": pa.array(np.full(len(keys), block, np.int64)), "key": pa.array(keys[order]),
                                  "f": pa.array(relation.counts()[order].astype(np.int64))})
                yield from table.to_batches(max_chunksize=1 << 17)
    return run


def _kept(longer: bool):
    def run(key, state, frequent):
        rows = {"block": [], "occurrences": [], "state": []}
        if len(frequent) and len(state):
            relation = Relation.unpacked(state["state"][0].as_py())
            relation = (relation.longer() if longer else relation).semi_join(frequent["key"].to_numpy())
            rows = {"block": [key[0].as_py()], "occurrences": [len(relation.at)], "state": [relation.packed()]}
        pa.default_memory_pool().release_unused()
        return pa.table(rows, schema=pa.schema([("block", pa.int64()), ("occurrences", pa.int64()), ("state", pa.binary())]))
    return run


def _phrase_counts(batches):
    for batch in batches:
        for blob in batch["state"]:
            relation = Relation.unpacked(blob.as_py())
            lang = pa.array(relation.langs, pa.string()).take(pa.array(relation.lang))
            table = pa.table({"lang": lang, "phrase": relation.phrases().cast(pa.string()), "f": pa.array(relation.counts().astype(np.int64))})
            yield from table.to_batches(max_chunksize=1 << 17)


def frequent_phrases(docs: DataFrame, longest: int = 4, least: int = 30, text: str = "text", lang: str = "lang",
                     block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, k, phrase, f) of every phrase of 1 to ``longest`` words that occurs ``least`` times, and (lang, n), the words of each language.

    Words, pieces and edge cases are those of ``collocations``. Both results are written tables.
    """
    spark = docs.sparkSession
    spread = max(1, -(-text_bytes(docs, text) // (BLOCKS_IN_BUCKET * block_bytes)))
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    path = _bucketed(rows.mapInArrow(_blocks(block_bytes), f"{_STATE}, langs array<string>, n array<bigint>"), "phrase-words", spread)
    words = spark.table(_name(path)).select(F.explode(F.arrays_zip("langs", "n")).alias("x")).groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.n").alias("n"))
    totals, counted = _written(words.where("n > 0"), "phrase-totals"), None
    for k in range(1, longest + 1):
        state = spark.table(_name(path)).select("block", "state")
        counts = state.mapInArrow(_group_counts(k > 1), "block bigint, key bigint, f bigint")
        frequent = counts.withColumn("f", F.sum("f").over(W.partitionBy("key"))).where(F.col("f") >= least).select("block", "key")
        kept = state.groupBy("block").cogroup(frequent.groupBy("block")).applyInArrow(_kept(k > 1), _STATE)
        shorter, path = path, _bucketed(kept, f"phrase-{k}", spread)
        del state, counts, frequent, kept
        _dropped(spark, shorter)
        exact = spark.table(_name(path)).select("state").mapInArrow(_phrase_counts, "lang string, phrase string, f bigint")
        exact = exact.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least).select("lang", F.lit(k).alias("k"), "phrase", "f")
        exact = _written(exact, f"phrase-counts-{k}")
        counted = exact if counted is None else counted.unionAll(exact)
        del exact
    _dropped(spark, path)
    return counted, totals


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, inside: int = 80, top: int = 2000, text: str = "text", lang: str = "lang",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per language its ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    Texts lose the case of A to Z, are split into pieces at ``. , ; : ! ?`` and line ends, and pieces into words at blanks and tabs.
    a, l and r count the phrase and the two parts of its lowest-scoring cut, at all places inside pieces; the score is
    floor(2000000 a / (l + r)); a phrase occurs ``least`` times. A phrase that lies in a longer one with ``inside`` percent of its
    count is left out. Order: score and a falling, phrase rising by its bytes, so ranks have no ties. Null languages are ``und``, null
    texts empty; repeated rows count each time; other columns are ignored. A language without such phrases has no row.
    """
    counted, totals = frequent_phrases(docs, longest, least, text, lang, block_bytes)
    long = counted.where("k > 1")
    word = F.split("phrase", " ")
    cuts = long.select("lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), word.alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"),
                       F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("tail"))
    f = counted.select("lang", "phrase", "f")
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(f.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = F.expr("(cast(2000000 as decimal(10, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("x"))
    covering = None
    for size in range(2, longest):
        starts = F.explode(F.sequence(F.lit(1), F.col("k") - size + 1))
        some = long.where(F.col("k") > size).select("lang", F.col("f").alias("longer"), word.alias("w"), starts.alias("i"))
        some = some.select("lang", F.array_join(F.slice("w", F.col("i"), F.lit(size)), " ").alias("phrase"), "longer")
        covering = some if covering is None else covering.unionAll(some)
    if covering is not None:
        most = covering.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        drop = F.col("longer").cast("decimal(19, 0)") * 100 >= F.col("a").cast("decimal(19, 0)") * inside
        scored = scored.join(most, ["lang", "phrase"], "left").where(~F.coalesce(drop, F.lit(False)))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("bigint")
    out = scored.select("lang", "phrase", "a", "x.l", "x.r", "x.score").withColumn("rank", rank).where(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
