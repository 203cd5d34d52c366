"""Problem 5: several values packed in one field.

A field's delimiter skeleton masks every run of ordinary characters by one symbol and keeps
the quotes, so a field is a sequence of tokens and its skeleton has one symbol a token. How
a field splits depends on its skeleton alone: the splitting rule (token ranges and whether
they are quoted) is resolved once per distinct skeleton, brought back to the rows, and
applied by position inside the JVM.

Distinct skeletons are counted and measured. If they are few, their rules are broadcast. Beyond
the bound those that hold more than a share of all fields are broadcast (the share bounds
their number), which leaves no hot skeleton: fields of all others are joined with their rules
by a shuffle on the skeleton.

A code is the text inside a pair of quotes (`""` inside double quotes is one `"`), or a
longest run of A-Z, 0-9 and hyphens without the hyphens at its ends. The label `UOC:` in any
case, lower-case letters and everything else outside quotes only separate. An unpaired quote
separates; where only doubled quotes are left to close a field, the last of them closes it;
empty quotes hold no code. Null and empty fields give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsloom.session import BROADCAST_BYTES, BROADCAST_ROWS, cut_lineage, join_hot, measured

#: Beyond the broadcast bound, skeletons of more than one in FREQUENT fields are still broadcast: fewer than FREQUENT.
FREQUENT = 10_000

#: Opening quotes and what closes them.
QUOTES = {'"': '"', "'": "'", "“": "”", "‘": "’", "„": "“”", "«": "»"}
_QUOTE_CLASS = "\"'“”‘’„«»"

LABEL = r"(?<![A-Za-z0-9])[Uu][Oo][Cc]:"
RUN = r"[A-Z0-9\-]*[A-Z0-9][A-Z0-9\-]*"
TOKEN = rf"{LABEL}|(?:(?!{LABEL})[A-Z0-9\-])+|[{_QUOTE_CLASS}]|(?:(?!{LABEL})[^A-Z0-9\-{_QUOTE_CLASS}])+"


def skeleton(field: Column) -> Column:
    """One symbol a token: L label, A run, - hyphens, a quote itself, blank for the rest."""
    s = F.regexp_replace(field, LABEL, "\u0001")
    s = F.regexp_replace(s, RUN, "A")
    s = F.regexp_replace(s, "-+", "-")
    s = F.regexp_replace(s, rf"[^A\-{_QUOTE_CLASS}\u0001]+", " ")
    return F.translate(s, "\u0001", "L")


def resolve(skel: str) -> list[tuple[int, int, str]]:
    """(first token from 1, number of tokens, the quote or '') of each code of a skeleton."""
    out, i, n = [], 0, len(skel)
    while i < n:
        c = skel[i]
        closing = QUOTES.get(c)
        if closing:
            j, doubled = i + 1, n
            while j < n:
                if skel[j] in closing:
                    if c == '"' and skel.startswith('""', j):
                        doubled, j = j, j + 2
                        continue
                    break
                j += 1
            if j >= n:
                j = doubled  # never closed after a doubled quote: its first half closes
            if j < n:
                if j > i + 1:
                    out.append((i + 2, j - i - 1, c))
                i = j + 1
                continue
        elif c == "A":
            out.append((i + 1, 1, ""))
        i += 1
    return out


def split_rules(skeletons: DataFrame) -> DataFrame:
    """`skel`, its number of fields `n` and its rule, for a table of distinct skeletons."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rules = [[{"at": a, "n": n, "quote": q} for a, n, q in resolve(s)] for s in pdf["skel"]]
            yield pd.DataFrame({"skel": pdf["skel"], "n": pdf["n"], "rule": rules})

    return skeletons.mapInPandas(run, "skel string, n bigint, rule array<struct<at:int,n:int,quote:string>>")


def explode_codes(df: DataFrame, key: str = "row_id", column: str = "uoc", least: int = 2, max_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """(key, pos, code): one row a code, for fields that hold at least `least` codes."""
    src = df.select(F.col(key).alias("_k"), F.col(column).alias("_v")).where(F.col("_v").isNotNull() & (F.col("_v") != ""))
    src = src.withColumn("skel", skeleton(F.col("_v")))
    rules = cut_lineage(split_rules(src.groupBy("skel").agg(F.count("*").alias("n"))).where(F.size("rule") >= least))
    tokens = F.regexp_extract_all("_v", F.lit(TOKEN), 0)

    def cut(toks: Column, r: Column) -> Column:
        plain = F.regexp_replace(F.get(toks, r["at"] - 1), "^-+|-+$", "")
        text = F.array_join(F.slice(toks, r["at"], r["n"]), "")
        return F.when(r["quote"] == "", plain).when(r["quote"] == '"', F.replace(text, F.lit('""'), F.lit('"'))).otherwise(text)

    # Bound by a lambda, so that a field is cut into tokens once and not once a code.
    codes = F.transform(F.array(tokens), lambda t: F.transform("rule", lambda r: cut(t, r)))[0]
    split = lambda rows: rows.select("_k", codes.alias("codes"))
    count, width = measured(rules)
    if count <= max_broadcast and width <= BROADCAST_BYTES:
        out = split(src.join(F.broadcast(rules.drop("n")), "skel"))
    else:
        total = rules.agg(F.sum("n")).first()[0] or 0
        often = F.col("n") * min(FREQUENT, max_broadcast) > total
        known, rare = rules.where(often).drop("n"), rules.where(~often).drop("n")
        if measured(known)[1] <= BROADCAST_BYTES:
            near = split(src.join(F.broadcast(known), "skel"))
        else:
            near = split(join_hot(cut_lineage(src), known, ["skel"], ["_k", "_v"]))
        # Few fields each: no skeleton is hot here.
        out = near.unionByName(split(src.join(rare, "skel")))
    return out.select(F.col("_k").alias(key), F.posexplode("codes").alias("pos", "code")).withColumn("pos", F.col("pos") + 1)
