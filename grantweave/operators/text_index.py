"""Pattern search over names and titles by an inverted index of trigrams.

Every three characters in a row of a folded text are a posting. A pattern's literal stretches must occur
in whatever it finds, so their rarest trigrams name the candidates, and only those are tried by the pattern.
A pattern without three literal characters in some alternative prunes nothing and all rows are tried.
Results are always those of the full scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantweave.operators.analytics import text_matches

#: Trigrams of an alternative that are looked up, the rarest first.
LOOKUPS = 4
#: Other characters whose simple case folding is an ASCII letter.
_FOLDED = ("İıſ\u212a", "iisk")


def folded(text: Column) -> Column:
    return F.lower(F.translate(text, *_FOLDED))


def postings(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(trigram, key): what occurs in any of the columns, once for each row; rows that share a key repeat it."""

    def grams(column: str) -> Column:
        text = F.coalesce(folded(F.col(column)), F.lit(""))
        return F.when(F.length(text) > 2, F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3))))

    every = F.flatten(F.array(*[F.coalesce(grams(c), F.array().cast("array<string>")) for c in columns]))
    return df.where(F.col(key).isNotNull()).select(F.explode(F.array_distinct(every)).alias("trigram"), F.col(key).alias("key"))


def write_index(df: DataFrame, key: str, columns: Sequence[str], folder: str) -> None:
    """Postings in the order of their trigrams, so a look-up reads few row groups, and how many each has.

    The range holds the key too, so that a trigram of most rows fills several files.
    """
    found = postings(df, key, columns).repartitionByRange("trigram", "key").sortWithinPartitions("trigram", "key")
    found.write.mode("overwrite").parquet(f"{folder}/postings")
    stored = df.sparkSession.read.parquet(f"{folder}/postings")
    counts = stored.groupBy("trigram").agg(F.count(F.lit(1)).alias("n")).orderBy("trigram")
    counts.write.mode("overwrite").parquet(f"{folder}/counts")


def alternatives(pattern: str) -> list[list[str]] | None:
    """The literal stretches that each top-level alternative must contain; None if that can't be told.

    Cautious: anything but plain characters ends a stretch, and a character that may be left out isn't in one.
    """
    if re.search(r"\\[QExucNpP0-9k]|\(\?", pattern):
        return None
    out, runs, now, depth, i = [], [], "", 0, 0

    def close():
        nonlocal now
        runs.append(now)
        now = ""

    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            following = pattern[i + 1 : i + 2]
            if following.isalnum() or not following or depth:
                close()
            else:
                now += following
            i += 1
        elif c == "[":
            close()
            # A class ends at its own bracket; nested ones are left to the full scan.
            end = re.compile(r"\[\^?\]?(?:[^\[\]\\&]|\\.)*\]").match(pattern, i)
            if not end:
                return None
            i = end.end() - 1
        elif c == "(":
            close()
            depth += 1
        elif c == ")":
            close()
            depth -= 1
            if depth < 0:
                return None
        elif c == "|":
            close()
            if not depth:
                out.append(runs)
                runs = []
        elif c in "?*{+":
            # What is repeated or left out is the last character.
            now = now[:-1]
            close()
            if c == "{":
                i = pattern.find("}", i)
                if i < 0:
                    return None
        elif c in ".^$":
            close()
        elif depth:
            pass
        else:
            now += c
        i += 1
    close()
    if depth:
        return None
    return [[r for r in rs if r] for rs in [*out, runs]]


def trigrams_of(stretches: list[str]) -> list[str]:
    """Trigrams of ASCII characters only, whose case folds alike everywhere."""
    found = {r[i : i + 3].lower() for r in stretches for i in range(len(r) - 2)}
    return sorted(g for g in found if g.isascii())


def candidates(folder: str, spark, needle: str, quote: bool = False) -> DataFrame | None:
    """Keys of the rows that a pattern may find, or None if all may be."""
    ways = [[needle]] if quote else alternatives(needle)
    if ways is None:
        return None
    # The literal text is looked for too (fiscal codes).
    wanted = [trigrams_of(w) for w in [*ways, *([] if quote else [[needle]])]]
    if not all(wanted[: len(ways)]) or (not wanted[-1] and needle.isascii()):
        return None
    wanted = [w for w in wanted if w]
    every = sorted({g for w in wanted for g in w})
    counts = spark.read.parquet(f"{folder}/counts").where(F.col("trigram").isin(every))
    n = {r.trigram: r.n for r in counts.collect()}
    stored = spark.read.parquet(f"{folder}/postings")
    parts = []
    for grams in wanted:
        rarest = sorted(grams, key=lambda g: n.get(g, 0))[:LOOKUPS]
        # A bit for each trigram, so that a repeated posting counts once.
        bit = reduce(lambda c, i: c.when(F.col("trigram") == rarest[i], F.lit(1 << i)), range(1, len(rarest)), F.when(F.col("trigram") == rarest[0], F.lit(1)))
        hits = stored.where(F.col("trigram").isin(rarest)).groupBy("key").agg(F.bit_or(bit).alias("_bits"))
        parts.append(hits.where(F.col("_bits") == (1 << len(rarest)) - 1).select("key"))
    return reduce(DataFrame.union, parts).distinct()


def indexed_search(
    df: DataFrame, folder: str, needle: str, key: str, patterned: Sequence[str], literal: Sequence[str] = (), quote: bool = False
) -> DataFrame:
    """Rows where the pattern occurs in a patterned column, or the needle as written in a literal one.

    ``folder`` has the index of all these columns.
    """
    tests = [text_matches(F.coalesce(F.col(c), F.lit("")), needle, quote) for c in patterned]
    tests += [F.coalesce(F.col(c), F.lit("")).contains(needle) for c in literal]
    found = candidates(folder, df.sparkSession, needle, quote)
    if found is not None:
        df = df.join(found.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left_semi")
    return df.where(reduce(Column.__or__, tests))
