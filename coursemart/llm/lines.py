"""Line dedup by a deletion-neighbourhood join: equal lines, and lines within one edit, keep the earliest.

Two lines are within one edit when both lose a character at one place and are then equal (substitution), or
when one loses a character and is then the other (insertion, deletion). All such variants of a long line
are many, so they are made in two steps that lose nothing:

1. *Block variants*: a line without one of its BLOCKS blocks (for its own length, and for the length one less).
   An edit lies in one block, so lines within one edit agree in one of these hashed keys.
2. *Character variants*: lines that met another line on a block variant delete each character of that block; the
   hashed results are joined, and the edit distance of the pairs is verified on the lines themselves.

In a group of equal variants only links to the earliest line (or to the line that equals the variant) are
made, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.llm.common import INVERSE, column_runs, cut, mix64, powers, quoted, text_or_empty

BLOCKS = 4
MIN_FUZZY = 20               # characters from which a line may differ by an edit unless the caller says otherwise; shorter ones must be equal
BROADCAST_BYTES = 32 << 20
RUN_BYTES = 512 << 10          # text hashed at once
VARIANT_CHARS = 50_000         # characters of the lines whose variants are made at once
MUL = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


class Lines:
    """Lines as one array of code points with prefix sums of a polynomial: the hash of a line without any
    stretch of it is a difference."""

    def __init__(self, lines: list[str]):
        self.n = np.array([len(x) for x in lines], dtype=np.int64)
        self.at = np.cumsum(self.n) - self.n
        code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        self.code, self.place = code, np.arange(len(code)) - np.repeat(self.at, self.n)
        self.longest = int(self.n.max()) if len(self.n) else 0
        self.back = powers(self.longest + 2, INVERSE)
        with np.errstate(over="ignore"):
            term = (mix64(code + np.uint64(1)) | np.uint64(1)) * powers(self.longest + 2)[self.place]
            self.sum = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term, dtype=np.uint64)])

    def without(self, line: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of each line without its characters a..b-1 (equal to the hash of the equal line)."""
        s, z = self.at[line], self.at[line] + self.n[line]
        with np.errstate(over="ignore"):
            left = self.sum[s + a] - self.sum[s]
            right = (self.sum[z] - self.sum[s + b]) * self.back[b - a]
            return mix64(left + right)

    def second(self) -> np.ndarray:
        """An independent hash of each line, so that equal lines are told by 128 bits."""
        with np.errstate(over="ignore"):
            term = mix64(self.code ^ np.uint64(0xD6E8FEB86659FD93)) * powers(self.longest + 2, SECOND)[self.place]
            total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term, dtype=np.uint64)])
            return mix64(total[self.at + self.n] - total[self.at])

    def whole(self) -> np.ndarray:
        k = np.arange(len(self.n))
        zero = np.zeros(len(k), dtype=np.int64)
        return self.without(k, zero, zero)


def edges(n: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Block q of a line of n characters."""
    return q * n // BLOCKS, (q + 1) * n // BLOCKS


def tagged(h: np.ndarray, *tags) -> np.ndarray:
    with np.errstate(over="ignore"):
        for t in tags:
            h = mix64(h * MUL + (t.astype(np.uint64) if isinstance(t, np.ndarray) else np.uint64(t)))
    return h


def block_keys(x: Lines) -> np.ndarray:
    """(lines x 2 BLOCKS): for its own length and for one less, the line without each block."""
    k = np.arange(len(x.n))
    out = np.empty((len(k), 2 * BLOCKS), dtype=np.uint64)
    for less in (0, 1):
        n = np.maximum(x.n - less, 0)
        for q in range(BLOCKS):
            a, b = edges(n, q)
            out[:, less * BLOCKS + q] = tagged(x.without(k, a, np.minimum(b + less, x.n)), n, q)
    return out


def variant_keys(x: Lines, met: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, key, kind: 's', 'd' or 'w') of the character variants: ``met`` (lines x 2 BLOCKS) says on which block
    variants a line met another. Substitutions meet on (length, place, rest); a shorter line, as it is,
    meets the longer lines that lose a character."""
    line, key, kind = [], [], []
    for less in (0, 1):
        for q in range(BLOCKS):
            k = np.flatnonzero(met[:, less * BLOCKS + q])
            if not len(k):
                continue
            a, b = edges(x.n[k] - less, q)
            b = np.minimum(b + less, x.n[k])
            size = b - a
            who = np.repeat(k, size)
            i = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(a, size)
            h = x.without(who, i, i + 1)
            line.append(who)
            key.append(tagged(h, x.n[who], i, 7) if less == 0 else tagged(h, 9))
            kind.append(np.full(len(who), "d" if less else "s"))
    k = np.flatnonzero(met[:, :BLOCKS].any(axis=1))
    line.append(k)
    key.append(tagged(x.without(k, np.zeros(len(k), np.int64), np.zeros(len(k), np.int64)), 9))
    kind.append(np.full(len(k), "w"))
    return np.concatenate(line), np.concatenate(key), np.concatenate(kind)


def split_lines(text: str) -> list[str]:
    """The lines of a text, spaces at their ends removed; blank ones are empty."""
    return [x.strip(" ") for x in text.split("\n")]


def _line_rows(docs: DataFrame, id_col: str, text_col: str, min_fuzzy: int) -> DataFrame:
    """(id, tk, no, h, h2, keys): every line that is not blank; keys only for lines that may differ by an edit."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("body")).withColumn("tk", F.xxhash64("body"))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, _, bodies in column_runs(b.column("body"), RUN_BYTES):
                lines, doc, no = [], [], []
                for z, body in enumerate(bodies):
                    for k, x in enumerate(split_lines(body.decode())):
                        if x:
                            lines.append(x)
                            doc.append(a + z)
                            no.append(k)
                x = Lines(lines)
                h = x.whole()
                keys = block_keys(x).astype(np.int64)
                fuzzy = x.n >= min_fuzzy
                flat = keys[fuzzy].ravel()
                at = np.concatenate([[0], np.cumsum(np.where(fuzzy, 2 * BLOCKS, 0))]).astype(np.int32)
                take = pa.array(doc, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(take), b.column("tk").take(take), pa.array(no, pa.int32()), pa.array(h.astype(np.int64)),
                     pa.array(x.second().astype(np.int64)), pa.ListArray.from_arrays(pa.array(at), pa.array(flat, pa.int64()))],
                    names=["id", "tk", "no", "h", "h2", "keys"])

    return rows.mapInArrow(run, f"id {kind}, tk long, no int, h long, h2 long, keys array<long>")


def _small(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """Broadcast a written table when its counted rows are few; otherwise the join shuffles."""
    return F.broadcast(df) if df.count() * bytes_per_row <= BROADCAST_BYTES else df


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_fuzzy: int = MIN_FUZZY) -> DataFrame:
    """(id, tk, dropped): for each document with lines to drop, their numbers. A line that is not blank goes if
    an earlier one (smaller id, then text hash, then line number; a null id last) is equal, or - both from ``min_fuzzy``
    characters, 1 for all lines - within one edit. Whether that earlier line stays does not matter."""
    rows = cut(_line_rows(docs, id_col, text_col, min_fuzzy), "lines")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "tk", "no")
    lines = cut(rows.select("h", "h2", order.alias("o"), "keys")
                .groupBy("h", "h2").agg(F.min("o").alias("first"), F.count(F.lit(1)).alias("times"), F.min_by("keys", "o").alias("keys")), "distinct-lines")
    # block variants that two different lines share
    block = lines.select("h", F.posexplode("keys").alias("slot", "key"))
    met = block.join(block.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "key")
    suspects = cut(met.groupBy("h").agg(F.collect_set("slot").alias("slots")), "suspects")
    spelled = cut(_spell(docs, suspects, text_col, min_fuzzy), "suspect-lines")
    firsts = lines.join(suspects.select("h"), "h", "left_semi").select("h", "first")
    # links: a group's members to its earliest, or to the line that the variant is
    variants = _variants(spelled).join(firsts, "h")
    groups = (variants.groupBy("key").agg(F.min(F.struct("first", "h")).alias("low"), F.count(F.lit(1)).alias("m"),
                                          F.min(F.when(F.col("whole"), F.struct("first", "h"))).alias("own"), F.max("sub").alias("sub"))
              .filter("m > 1 and (sub or own is not null)")
              .select("key", F.when(F.col("sub"), F.col("low")).otherwise(F.col("own")).alias("hub")))
    links = (variants.join(groups, "key").filter(F.col("h") != F.col("hub.h"))
             .select(F.when(F.col("first") < F.col("hub.first"), F.col("hub.h")).otherwise(F.col("h")).alias("late"),
                     F.when(F.col("first") < F.col("hub.first"), F.col("h")).otherwise(F.col("hub.h")).alias("early")).distinct())
    a, b = spelled.select(F.col("h").alias("late"), F.col("line").alias("late_line")), spelled.select(F.col("h").alias("early"), F.col("line").alias("early_line"))
    late = (links.join(a, "late").join(b, "early").filter(F.levenshtein("late_line", "early_line", 1) >= 0)
            .select(F.col("late").alias("h"), F.lit(True).alias("near")).distinct())
    decided = (lines.select("h", "h2", "first", "times").join(late, "h", "left").filter("times > 1 or near")
               .select("h", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")))
    gone = (rows.select("id", "tk", "no", "h", "h2").join(decided, ["h", "h2"])
            .filter(F.col("near") | ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("tk") == F.col("first.tk")) & (F.col("no") == F.col("first.no")))))
    return gone.groupBy("id", "tk").agg(F.sort_array(F.collect_set("no")).alias("dropped"))


def _spell(docs: DataFrame, suspects: DataFrame, text_col: str, min_fuzzy: int) -> DataFrame:
    """(h, line, slots) of the suspect lines, read again from the texts."""
    bodies = docs.select(text_or_empty(text_col).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, bodies in column_runs(b.column("body"), RUN_BYTES):
                lines = list(dict.fromkeys(x for t in bodies for x in split_lines(t.decode()) if len(x) >= max(min_fuzzy, 1)))
                h = Lines(lines).whole().astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(lines, pa.string())], names=["h", "line"])

    found = bodies.mapInArrow(run, "h long, line string").join(_small(suspects, 64), "h")
    return found.dropDuplicates(["h"])


def _variants(spelled: DataFrame) -> DataFrame:
    """(key, h, whole, sub): the character variants of the suspect lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, lines, slots = b.column("h").to_numpy(), b.column("line").to_pylist(), b.column("slots").to_pylist()
            a = 0
            while a < len(lines):
                z, size = a + 1, len(lines[a])
                while z < len(lines) and size + len(lines[z]) <= VARIANT_CHARS:  # each character makes up to two variants
                    size += len(lines[z])
                    z += 1
                x = Lines(lines[a:z])
                met = np.zeros((len(x.n), 2 * BLOCKS), dtype=bool)
                for i, s in enumerate(slots[a:z]):
                    met[i, s] = True
                line, key, kind = variant_keys(x, met)
                for k in range(0, len(key), VARIANT_CHARS):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[k:k + VARIANT_CHARS].astype(np.int64)), pa.array(h[a + line[k:k + VARIANT_CHARS]]),
                         pa.array(kind[k:k + VARIANT_CHARS] == "w"), pa.array(kind[k:k + VARIANT_CHARS] == "s")], names=["key", "h", "whole", "sub"])
                a = z

    return spelled.mapInArrow(run, "key long, h long, whole boolean, sub boolean")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_fuzzy: int = MIN_FUZZY) -> DataFrame:
    """(row: struct of the columns of ``docs``, clean, n_lines, dropped): one row per row of ``docs``; ``clean`` is the
    text without the dropped lines, ``dropped`` their numbers from 0.

    Null and empty texts have no lines to drop and stay as they are; blank lines stay; rows with equal id and
    text are one document and get the same result; an empty table gives an empty table; other columns of
    any name pass through in ``row``. Lines of fewer than ``min_fuzzy`` characters go only if equal (1: every line
    may differ by an edit). A long text's lines are dealt out like any others."""
    gone = repeated_lines(docs, id_col, text_col, min_fuzzy)
    packed = docs.select(F.struct(*quoted(docs)).alias("row"))
    packed = packed.select("row", F.col(f"row.{id_col}").alias("r_id"), F.xxhash64(text_or_empty(f"row.{text_col}")).alias("r_tk"))
    j = (packed.join(gone, F.col("r_id").eqNullSafe(F.col("id")) & (F.col("r_tk") == F.col("tk")), "left")
         .select("row", F.col(f"row.{text_col}").cast("string").alias("body"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped")))
    schema = T.StructType([j.schema["row"], T.StructField("clean", T.StringType()), T.StructField("n_lines", T.IntegerType()),
                           T.StructField("dropped", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            clean, count = [], []
            for t, drop in zip(b.column("body").to_pylist(), b.column("dropped").to_pylist()):
                lines = (t or "").split("\n")
                count.append(len(lines) if t else 0)
                if drop:
                    out = set(drop)
                    clean.append("\n".join(x for k, x in enumerate(lines) if k not in out))
                else:
                    clean.append(t)
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(clean, pa.string()), pa.array(count, pa.int32()), b.column("dropped")],
                                             names=["row", "clean", "n_lines", "dropped"])

    return j.mapInArrow(run, schema)


#: Blocks by halves instead (one half of a pair within one edit is equal), and the edit distance by DuckDB.
ORACLE = """
with s as (select doc_id, text, string_split(coalesce(text, ''), chr(10)) parts from documents),
l as (select doc_id, unnest(range(0, len(parts))) no, trim(unnest(parts), ' ') line from s),
f as (select line, min_by(doc_id, struct_pack(a := doc_id, b := no)) d, min_by(no, struct_pack(a := doc_id, b := no)) k, length(line) n
      from l where line <> '' group by line),
h as (select line, d, k, n, m, unnest([0, 1]) side from (select *, unnest([n, n - 1]) m from f where n >= 20)),
q as (select *, case when side = 0 then left(line, m // 2) else substr(line, n - (m - m // 2) + 1) end half from h),
c as (select distinct a.line, b.line other from q a join q b using (m, side, half)
      where a.line <> b.line and abs(a.n - b.n) <= 1 and (b.d < a.d or (b.d = a.d and b.k < a.k))),
z as (select distinct line from c where levenshtein(line, other) <= 1),
g as (select l.doc_id, l.no, l.line <> '' and (z.line is not null or l.doc_id <> f.d or l.no <> f.k) gone
      from l left join f on l.line = f.line left join z on l.line = z.line),
w as (select doc_id, list(no order by no) filter (gone) dropped from g group by doc_id),
t as (select doc_id, unnest(parts) part, unnest(range(0, len(parts))) no from s),
o as (select t.doc_id, string_agg(part, chr(10) order by t.no) filter (not gone) clean from t join g on t.doc_id = g.doc_id and t.no = g.no group by t.doc_id)
select s.doc_id, case when s.text is null then null else coalesce(o.clean, '') end "text",
       (case when coalesce(s.text, '') = '' then 0 else len(parts) end)::integer n_lines,
       coalesce(len(w.dropped), 0)::integer n_dropped, array_to_string(coalesce(w.dropped, []), ',') dropped_lines
from s join w on s.doc_id = w.doc_id join o on s.doc_id = o.doc_id
"""
