"""Benchmark decontamination by template canonicalisation.

A word is stripped of ASCII punctuation at its ends and lower-cased; a word with a digit, or a number word, becomes the
placeholder *number*; a unit word after a number becomes *unit*; a capitalised word that does not begin a sentence
becomes *name*.  Windows of ``WINDOW`` template words (shorter benchmark items: the whole item, sought anywhere in a document) are hashed
and joined.  Windows where fewer than half of the words are literal are shapes, not text: they are joined as they stand
(so a word-for-word copy of a list of numbers or names is found), and as templates only where another window of the item
has already placed it.
An item is found in a document when, at one alignment, at least ``NEED`` of its windows (all, if it has fewer) match and
the slots are consistent: equal item values stand for equal document values.  So an item that was asked again with other
numbers, names or units is caught (kind ``reworded``), as is a literal copy (kind ``copy``), while a text that merely has
the same shape with contradicting values is not.

Scale: a fixed bitmap (``FILTER_BITS`` bits, 2 MB) of the hashes of all benchmark windows is the only thing sent to
every task, whatever the size of the benchmark; windows that pass it (matches, and a share of false ones that grows with
the benchmark) are joined by hash with Spark's own choice of join, which splits hot keys.

Defined results: null or blank texts and items match nothing; repeated rows are each found; null ids are carried along;
an empty benchmark finds nothing; columns of the input are packed whole, so their names can't clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import chunks as C
from strata.llm import tokens as T

WINDOW = 8
NEED = 6                                             # windows in a row of one alignment: 13 words
FILTER_BITS = 1 << 24
TEXT, SHAPE, LITERAL = 0, 1, 2                       # kinds of windows
SALTS = T.mix(np.arange(3, dtype=np.uint64))
NUMBER, NAME, UNIT = (T.mix(np.array([i], np.uint64))[0] for i in (11, 13, 17))

# Number and unit words.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion").split()
UNIT_WORDS = ("mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
              "kilometers kilometre kilometres mg g kg t lb lbs oz gram grams kilogram kilograms ton tons tonne tonnes "
              "pound pounds ounce ounces ml l liter liters litre litres gallon gallons s sec second seconds min minute "
              "minutes h hr hour hours day days week weeks month months year years % percent dollar dollars euro euros "
              "cent cents usd eur gbp hz khz mhz ghz w kw mw v kv a j kj n pa kpa mph kmh c f degrees degree "
              "stunden stunde tage tag jahre jahr heures heure jours jour ans horas hora dias años").split()

PUNCT = np.zeros(256, bool)
PUNCT[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "%"]] = True
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?:;"]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True


def word_names(words: list[str]) -> np.ndarray:
    buf, off = T.buffers(pa.array([" ".join(words)]))
    return np.sort(T.Words(buf, off).names())


NUMBERS, UNITS = word_names(NUMBER_WORDS), word_names(UNIT_WORDS)


def is_in(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def so_far(flags: np.ndarray) -> np.ndarray:
    """How many of the flags before each place, and before the end, are set."""
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def passes(h: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Places of the hashes whose bit is set."""
    cells = h & T.U(FILTER_BITS - 1)
    return np.flatnonzero((bitmap[(cells >> T.U(5)).astype(np.int32)] >> (cells & T.U(31)).astype(np.uint32)) & 1)


class Templates:
    """Template names of the words of some texts, and their surface spans."""

    def __init__(self, col):
        w = T.Words(*T.buffers(col))
        buf, start, end = w.buf, w.start.copy(), w.end.copy()
        upper = ((buf >= 65) & (buf <= 90))
        two = np.r_[False, buf[:-1] == 0xC3] & (buf >= 0x80) & (buf <= 0x9E) & (buf != 0x97) if len(buf) else upper
        low = np.where(upper | two, buf + 32, buf).astype(np.uint8)
        last = w.end - 1
        stops = STOP[buf[last]] if len(start) else np.zeros(0, bool)
        more = np.arange(len(start))
        while len(more):                             # punctuation at the front
            more = more[(start[more] < end[more])]
            more = more[PUNCT[buf[start[more]]]]
            start[more] += 1
        more = np.arange(len(start))
        while len(more):
            more = more[(start[more] < end[more])]
            more = more[PUNCT[buf[end[more] - 1]]]
            end[more] -= 1
        name = T.span_names(low, start, end)
        digits = so_far(DIGIT[buf])
        number = (digits[end] > digits[start]) | is_in(name, NUMBERS)
        del digits, low
        head = np.minimum(start, max(len(buf) - 1, 0))
        capital = ((upper[head] | (np.r_[two[1:], False][head] if len(buf) else upper[head])) & (start < end)) if len(start) \
            else np.zeros(0, bool)
        begins = np.ones(len(start), bool)           # after a stop, a line break or at the front of a text
        if len(start) > 1:
            lines = so_far(buf == 10)
            begins[1:] = stops[:-1] | (lines[w.start[1:]] > lines[w.start[:-1]])
            del lines
            begins[w.first[:-1][w.first[:-1] < len(start)]] = True
        after_number = np.r_[False, number[:-1]] if len(start) else number
        if len(start):
            after_number[w.first[:-1][w.first[:-1] < len(start)]] = False
        unit = ~number & after_number & is_in(name, UNITS)
        proper = ~number & ~unit & capital & ~begins
        self.slot = np.where(number, 1, np.where(unit, 2, np.where(proper, 3, 0))).astype(np.int8)
        out = name.copy()
        out[number], out[unit], out[proper] = NUMBER, UNIT, NAME
        self.names, self.first, self.surface = out, w.first, name

    def windows(self, lengths=None, keep=None):
        """(hash, text number, start, words, kind) of the windows of ``WINDOW`` words, of those whose hash ``keep`` takes.

        The kind is ``TEXT`` where at least half of the template words are literal, else ``SHAPE``; windows near or below
        that share come as ``LITERAL`` ones (their words as they stand) too.  Without ``lengths`` a shorter text has its
        whole sequence as one window; with them texts have all windows of each of these lengths.  ``keep`` is asked per length
        and kind, so only one set of hashes is held at a time.
        """
        parts = []
        count = np.diff(self.first)
        lit = so_far(self.slot == 0)
        for k in lengths or [WINDOW]:
            h, off = T.shingles(self.names, self.first, k)
            doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
            at = self.first[:-1][doc] + np.arange(len(h)) - off[:-1][doc]
            size = np.minimum(count, k)[doc]
            words = lit[at + size] - lit[at]
            text, near = 2 * words >= size, 2 * words < size + 4
            fits = (size == k) | (lengths is None)
            del words
            for kind, on in ((TEXT, text), (SHAPE, ~text), (LITERAL, near)):
                if kind == LITERAL:
                    h, _ = T.shingles(self.surface, self.first, k)
                on = np.flatnonzero(on & fits)
                x = T.mix(h[on] ^ SALTS[kind])
                if keep is not None:
                    some = keep(x)
                    on, x = on[some], x[some]
                parts.append((x, doc[on], at[on], size[on], np.full(len(on), kind)))
            del h, x, off, doc, at, size, text, near, fits
        return tuple(np.concatenate(x) for x in zip(*parts))

    def slots(self, at: int, size: int, kind: int = 0) -> list[int]:
        return [] if kind == LITERAL else [int(x) for x in self.surface[at:at + size][self.slot[at:at + size] > 0].view(np.int64)]


SCHEMA = "h long, row long, pos long, kind long, slots array<long>"


def window_rows(h, row, pos, kind, slots) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(h.view(np.int64)), pa.array(row, pa.int64()), pa.array(pos, pa.int64()),
         pa.array(kind, pa.int64()), pa.array(slots, pa.list_(pa.int64()))], names=["h", "row", "pos", "kind", "slots"])


def find(chunks: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
         item_text: str = "text") -> DataFrame:
    """(row, item, n_matched, n_windows, kind): items found in rows of ``chunks``."""
    spark = chunks.sparkSession
    kind = benchmark.schema[item].dataType.simpleString()

    def items(batches):
        for b in batches:
            t = Templates(b.column(1))
            h, doc, at, size, of = t.windows()
            pos = at - t.first[doc]
            total = np.bincount(doc[of != LITERAL], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), b.column(0).take(pa.array(doc)), pa.array(pos, pa.int64()),
                 pa.array(total[doc], pa.int64()),
                 pa.array(size, pa.int64()), pa.array(of, pa.int64()),
                 pa.array([t.slots(*x) for x in zip(at.tolist(), size.tolist(), of.tolist())], pa.list_(pa.int64()))],
                names=["h", "item", "ipos", "n_windows", "size", "ikind", "islots"])

    wanted = C.write_table(benchmark.select(item, item_text).mapInArrow(
        items, f"h long, item {kind}, ipos long, n_windows long, size long, ikind long, islots array<long>"), "items")
    lengths = sorted({WINDOW, *(r["size"] for r in wanted.select("size").distinct().collect())})   # at most WINDOW numbers
    # bitmap words of 32 bits: at most FILTER_BITS / 32 rows at any size of the benchmark
    cell = F.pmod(F.col("h"), F.lit(FILTER_BITS))
    words = wanted.select(F.shiftright(cell.cast("long"), 5).alias("w"), F.expr(f"shiftleft(1L, cast(pmod(h, 32) as int))").alias("b"))
    got = words.groupBy("w").agg(F.bit_or("b").alias("b")).collect()
    flat = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in got:
        flat[r["w"]] = r["b"]
    bitmap = spark.sparkContext.broadcast(flat)

    def look(chunk, rows):
        t = Templates(rows.column(text))
        h, doc, at, size, of = t.windows(lengths, lambda x: passes(x, bitmap.value))
        if len(h):
            yield window_rows(h, (chunk << C.ROW_BITS) + doc, at - t.first[doc], of,
                              [t.slots(*x) for x in zip(at.tolist(), size.tolist(), of.tolist())])

    seen = C.write_table(C.over_chunks(chunks, look, SCHEMA), "windows")
    shift = (F.col("pos") - F.col("ipos")).alias("shift")
    cols = ["row", "item", "n_windows", "ipos", shift, F.arrays_zip("islots", "slots").alias("z")]
    hits = seen.where(F.col("kind") != SHAPE).join(wanted.where(F.col("ikind") != SHAPE), "h").select(*cols)
    # shapes find nothing by themselves: they are looked up where an alignment expects them
    placed = hits.select("row", F.col("item").alias("of"), "shift").distinct()
    shapes = (placed.join(wanted.where(F.col("ikind") == SHAPE), F.col("of").eqNullSafe(F.col("item")))
              .withColumn("pos", F.col("shift") + F.col("ipos")).drop("of", "shift")
              .join(seen.where(F.col("kind") == SHAPE), ["row", "pos", "h"]).select(*cols))
    paired = hits.unionByName(shapes)
    # a set of slot pairs per alignment is bounded by the item's length
    per = paired.groupBy("row", "item", "shift").agg(
        F.max("n_windows").alias("n_windows"), F.count_distinct("ipos").alias("n_matched"),
        F.array_distinct(F.flatten(F.collect_set("z"))).alias("z"))
    values = F.size(F.array_distinct(F.transform("z", lambda x: x["islots"])))
    ok = per.where((F.col("n_matched") >= F.least(F.lit(NEED), F.col("n_windows"))) & (F.size("z") == values))
    copy = F.forall("z", lambda x: x["islots"] == x["slots"])
    return ok.groupBy("row", "item").agg(
        F.max("n_matched").alias("n_matched"), F.max("n_windows").alias("n_windows"),
        F.when(F.max(copy.cast("int")) == 1, "copy").otherwise("reworded").alias("kind"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                 item: str = "item_id") -> DataFrame:
    """(id, item, n_matched, n_windows, kind) of every benchmark item found in a document."""
    chunks = C.pack(docs.select(id_col, text), text)
    kind = docs.schema[id_col].dataType.simpleString()
    found = C.write_table(find(chunks, benchmark, text, item), "found")
    asked = by_chunk(found.select("row").distinct())

    def ids(chunk, rows, got):
        for _, blob in got:
            row = C.spread(blob)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row, pa.int64()), rows.column(id_col).take(pa.array(row & ((1 << C.ROW_BITS) - 1)))], names=["row", id_col])

    named = C.back(chunks, asked, ids, f"row long, `{id_col}` {kind}")
    return found.join(named, "row").select(id_col, F.col("item").alias(item), "n_matched", "n_windows", "kind")


def by_chunk(rows: DataFrame) -> DataFrame:
    """Row numbers as one blob per chunk (at most the rows of the chunk)."""

    def run(batches):
        for b in batches:
            yield C.send([0] * b.num_rows, b.column(0).to_pylist(),
                         [C.squeeze(np.array(x, np.int64)) for x in b.column(1).to_pylist()])

    return (rows.groupBy(F.shiftright("row", C.ROW_BITS).alias("chunk")).agg(F.collect_list("row").alias("r"))
            .mapInArrow(run, C.SEND))


def drop_rows(chunks: DataFrame, rows: DataFrame, schema) -> DataFrame:
    """The packed rows whose number is not in ``rows``."""

    def run(chunk, batch, got):
        keep = np.ones(batch.num_rows, bool)
        for _, blob in got:
            keep[C.spread(blob)[0] & ((1 << C.ROW_BITS) - 1)] = False
        yield batch.filter(pa.array(keep))

    return C.back(chunks, by_chunk(rows), run, schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    chunks = C.pack(docs, text)
    found = find(chunks, benchmark, text, item).select("row").distinct()
    return drop_rows(chunks, found, docs.schema)
