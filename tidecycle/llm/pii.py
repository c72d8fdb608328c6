"""Personal data: base patterns, and contexts that are bootstrapped from what they find."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, slices

KINDS = ("email", "ip", "card", "phone")
LOCAL_CHARS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Matches as the plain pattern does, which always begins with a whole run of digits; runs are not tried again from their inside.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What may be an identifier that the base misses: words around an @, or digits with separators, seven digits at least.
MAYBE = re.compile(r"[^\s@]{1,64}@[^\s@]{1,255}|[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
NOT_DIGIT = re.compile("[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """As leftmost matching of `local@domain` would find them, in time linear in the text: each @ takes the longest local part before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        part = text[free:at]
        start = free + len(part.rstrip(LOCAL_CHARS))
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start; ends exclusive, in code points."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((3, *m.span()))
    return out


def possible_kinds(value: str) -> list[int]:
    """Kinds that an identifier could be by its characters."""
    if "@" in value:
        return [0]
    n = len(NOT_DIGIT.sub("", value))
    return [1] * (value.count(".") == 3) + [2] * (12 <= n <= 19) + [3] * (7 <= n <= 15)


def _general(word: str) -> str:
    """A word without its case and digits; a long one as its hash."""
    word = re.sub("[0-9]+", "0", word.lower())
    return word if len(word) <= 64 else hashlib.md5(word.encode()).hexdigest()


def shape(value: str) -> str:
    """Each digit as 0, runs of letters as a, no plus in front: what identifiers of a kind have in common."""
    out = re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]", "0", value.removeprefix("+")))
    return out if len(out) <= 64 else hashlib.md5(out.encode()).hexdigest()


class Neighbours:
    """The words of a text, for those before and after a place, however long they are."""

    def __init__(self, text: str):
        self.text = text
        spans = [m.span() for m in re.finditer(r"\S+", text)]
        self.starts, self.ends = [a for a, _ in spans], [b for _, b in spans]

    def before(self, at: int, k: int) -> list[str]:
        """Up to k words that end at `at` or earlier; ^ stands at the beginning of the text."""
        i, out = bisect_left(self.starts, at) - 1, []
        while i >= 0 and len(out) < k:
            out.append(_general(self.text[self.starts[i] : min(self.ends[i], at)]))
            i -= 1
        return ["^"] * (len(out) < k) + out[::-1]

    def after(self, at: int) -> str:
        """The word that begins at `at` or later; $ at the end of the text."""
        i = bisect_right(self.ends, at)
        return _general(self.text[max(self.starts[i], at) : self.ends[i]]) if i < len(self.ends) else "$"


def contexts(words: Neighbours, start: int, end: int) -> list[str]:
    """Lexical patterns around a place, from literal to general: two words before; the words before and after; the value's shape with the word before, with the word after, and with the word at a distance of two before."""
    two, after, kind = words.before(start, 2), words.after(end), shape(words.text[start:end])
    return [f"{' '.join(two)} _", f"{two[-1]} _ {after}", f"{two[-1]} <{kind}>", f"<{kind}> {after}", f"{two[0]} . <{kind}>"]


SPAN = T.ArrayType(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())]))
PLACE = "array<struct<k:int,s:int,e:int,value:string,may:array<int>,patterns:array<string>>>"


def _scan(batches):
    span = pa.list_(pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32())]))
    place = pa.list_(pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("value", pa.string()), ("may", pa.list_(pa.int32())), ("patterns", pa.list_(pa.string()))]))
    for batch in slices(batches, 1):
        bases, places = [], []
        for text in batch.column(1).to_pylist():
            text = text or ""
            base = base_spans(text)
            bases.append([{"k": k, "s": s, "e": e} for k, s, e in base])
            found = list(base)
            taken = sorted((s, e) for _, s, e in base)
            at = 0
            for m in MAYBE.finditer(text):
                while at < len(taken) and taken[at][1] <= m.start():
                    at += 1
                if at == len(taken) or taken[at][0] >= m.end():
                    found.append((None, *m.span()))
            words = Neighbours(text) if found else None
            places.append([{"k": k, "s": s, "e": e, "value": text[s:e], "may": possible_kinds(text[s:e]) if k is None else [k], "patterns": contexts(words, s, e)} for k, s, e in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bases, span), pa.array(places, place)], names=["id", "base", "places"])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = 5, precision: float = 0.8, accept: float = 0.9, rounds: int | None = None) -> DataFrame:
    """One row per input row: id, base and added (arrays of kind number, start, end; see KINDS).

    Base spans come from the four patterns, leftmost and non-overlapping within a kind. Other strings that could be
    identifiers are candidates, and each place of either has patterns from literal to general (`contexts`). Base spans are seeds; each round
    1. scores pattern-kind pairs: precision is the share of seeds of the kind among the distinct identifiers in that
       context that could be of the kind (base spans of other kinds count against it), `support` distinct seeds are needed;
    2. scores candidates through all patterns of a kind that reach `precision`: 1 - product of (1 - precision);
    3. takes those of `accept` or more as further seeds, all their places as added spans, and goes on till nothing is new (or for `rounds` rounds, if given).
    Null and empty texts have no spans, repeated rows are judged each, other columns are not read, an empty table gives
    none. The texts are scanned once; rounds run on the small table of identifier places, with partial sums before
    each shuffle.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, base array<struct<k:int,s:int,e:int>>, places {PLACE}"
    found = materialize(rows.mapInArrow(_scan, schema).withColumn("uid", F.monotonically_increasing_id()))
    places = found.select("uid", F.explode("places").alias("p")).select("uid", "p.*")
    graph = places.select("k", "value", F.explode("may").alias("may"), "patterns").select("k", "value", "may", F.explode("patterns").alias("pattern"))
    graph = materialize(graph.groupBy("value", "may", "pattern").agg(F.max("k").alias("k")))
    # Every known identifier in a context counts for all kinds there: for its own as a seed, for the others against them. An unknown one counts against the kinds that it could be of.
    seeds = materialize(graph.where("k IS NOT NULL").select("value", F.col("k").alias("kind"), F.lit(False).alias("new")).distinct())
    done = 0
    while rounds is None or done < rounds:
        known = graph.join(seeds, "value", "left")
        seen = known.where("kind IS NOT NULL").groupBy("pattern").agg(F.count_distinct("value").alias("seen"))
        unseen = known.where("kind IS NULL").groupBy("pattern", F.col("may").alias("kind")).agg(F.count_distinct("value").alias("unseen"))
        hits = known.where("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count_distinct("value").alias("good")).where(F.col("good") >= support)
        total = F.col("seen") + F.coalesce("unseen", F.lit(0))
        good = hits.join(seen, "pattern").join(unseen, ["pattern", "kind"], "left").withColumn("q", F.col("good") / total).where(F.col("q") >= precision).select("pattern", "kind", "q")
        fresh = graph.join(seeds.select("value").distinct(), "value", "left_anti").join(good, "pattern").where("may = kind")
        scored = fresh.groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("q"), F.lit(1e-9)))))).alias("q"))
        best = scored.where(F.col("q") >= accept).groupBy("value").agg(F.max(F.struct("q", (-F.col("kind")).alias("k"))).alias("b")).select("value", (-F.col("b.k")).alias("kind"), F.lit(True).alias("new"))
        best = materialize(best)
        if not best.limit(1).count():
            break
        done += 1
        seeds = seeds.unionByName(best)
        if done % 8 == 0:  # a long chain is not a long plan
            seeds = materialize(seeds)
    if not done:
        return found.select(F.col("id").alias(id_col), "base", F.array().cast(SPAN).alias("added"))
    taken = seeds.where("new").select("value", "kind")
    more = places.where("k IS NULL").join(taken, "value").groupBy("uid").agg(F.collect_list(F.struct(F.col("kind").alias("k"), "s", "e")).alias("added"))
    return found.join(more, "uid", "left").select(F.col("id").alias(id_col), "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"))


def span_text(spans: F.Column) -> F.Column:
    """kind:start:end by kind, then start, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def count_kind(spans: F.Column, kind: str) -> F.Column:
    return F.size(F.filter(spans, lambda x: x["k"] == KINDS.index(kind))).cast("long")
