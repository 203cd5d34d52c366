"""Problem 3: text values cut off before their end.

A value that was cut ends in a phrase that is a strict prefix of longer phrases elsewhere
and hardly ever stands for itself. Every value is split into phrases at commas, semicolons,
parentheses and sentence ends; phrases are folded to letters, digits and the inch mark, so
spacing, case and odd punctuation drop out; word boundaries are kept beside them. Distinct
values (by folded words) are counted, not rows, so copies of a row weigh nothing. Every
fixed-length prefix of every distinct phrase is hashed and its weight summed, and the sums
are joined with the phrases themselves: `n` values hold the phrase as it is, `ext` values
hold a longer phrase that starts with it, `mid` of these go on inside a word.

A last phrase that ends between two letters of a word of longer copies is cut whatever its
count, unless it is seen as a whole where a value goes on (more than `RATIO` of `mid`), or its
last word is and the longer copies are fewer. Any last phrase is cut when `n` is at most
`RATIO` of `ext`; that is the only test where the phrase ends at a word boundary. Phrases
with digits are tested a second time with every digit masked, so that a size cut before its
unit is found though the size itself is rare.

A source that cuts at a field limit shows it: among its distinct values of that length at
least `SPIKE` are cut by these tests. Values of that source and length are tested again with
the occurrences at such places left out of `n`, so that a common cut at a word boundary (one
value in twenty, say) is found where the limit explains it.

A value is cut, too, when it stops at a comma, semicolon, slash, ampersand or opening
parenthesis, or inside a parenthesis that others close.

Values are folded once and staged with their rows. The joins that find phrases run on
distinct phrases, after partial aggregation; a hot phrase is one row there. The flagged
phrases are brought back to the rows by a broadcast if measured to be few, else by a join that
salts hot phrases.

Defined results: null and blank values are no cases; values without a letter or digit are no
cases; a value of any length is read whole; rows with equal values have equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partsloom.session import BROADCAST_BYTES, BROADCAST_ROWS, broadcast_if_small, cut_lineage, fresh_names, join_hot, measured

#: A phrase at most this often itself, against longer phrases that begin with it, is a cut one.
#: Masked phrases are common, so their share must be smaller.
RATIO, MASKED_RATIO = 0.03, 0.01
#: Prefixes up to this length are all hashed; beyond it those at which a value with the same beginning ends.
DENSE = 64
#: A length is a source's field limit when this share of its distinct values of that length, and so many, are cut.
SPIKE, SPIKE_VALUES = 0.5, 10

_TAIL = r"[\s.…\uFFFD]+$"
_SPLIT = r"[,;()]+|(?<!\b[Nn][Oo])\.[\s ]+"
_NOISE = r'[^\p{L}\p{N}"]+'
_DANGLING = r"[,;/&(]$"


def _trimmed(value: Column) -> Column:
    return F.regexp_replace(value, _TAIL, "")


def _spaced(value: Column) -> Column:
    """The folded phrases of a value, in order, without empty ones, their words parted by single spaces."""
    fold = lambda p: F.trim(F.regexp_replace(F.lower(p), _NOISE, " "))
    return F.filter(F.transform(F.split(_trimmed(value), _SPLIT), fold), lambda p: p != "")


def _joined(words: Column) -> Column:
    return F.replace(words, F.lit(" "), F.lit(""))


def phrases(value: Column) -> Column:
    """The folded phrases of a value, in order, without empty ones."""
    return F.transform(_spaced(value), _joined)


def _masked(phrase: Column) -> Column:
    return F.regexp_replace(phrase, r"\p{N}", "0")


def dangling(value: Column) -> Column:
    """Whether a value stops where something must follow."""
    t = _trimmed(value)
    opened = F.length(F.replace(t, F.lit("("), F.lit(""))) < F.length(F.replace(t, F.lit(")"), F.lit("")))
    return t.rlike(_DANGLING) | opened


def folded_rows(df: DataFrame, value: str, source: str | None) -> tuple[DataFrame, dict[str, str]]:
    """A stage of the rows with their folded phrases (joined by commas), last phrase, length and source; the names of these columns."""
    names = dict(zip(("v", "p", "m", "l", "s", "d"), fresh_names(df, "_v", "_p", "_m", "_l", "_s", "_d")))
    v, p = names["v"], names["p"]
    rows = df.where(F.col(value).isNotNull()).withColumn(v, F.array_join(_spaced(F.col(value)), ","))
    rows = rows.withColumn(p, _joined(F.substring_index(v, ",", -1)))
    rows = rows.withColumn(names["m"], F.when(F.col(p).rlike(r"\p{N}"), F.concat(F.lit("#"), _masked(F.col(p)))))
    rows = rows.withColumn(names["l"], F.length(F.col(value))).withColumn(names["s"], F.col(source).cast("string") if source else F.lit(None).cast("string"))
    # Values without a phrase are left out behind the stage: a filter before it would fold every value again.
    return cut_lineage(rows.withColumn(names["d"], dangling(F.col(value)))).where(F.col(v) != ""), names


def phrase_weights(values: DataFrame) -> DataFrame:
    """(words, phrase, n, ends): every distinct phrase and masked phrase (with a leading `#`), in how many of the distinct folded
    values `v` it stands, and in how many of these at the end. `words` is the phrase with spaces between its words."""
    ps = values.select("v").distinct().select(F.split("v", ",").alias("ps"))
    tagged = F.transform("ps", lambda p, i: F.struct(p.alias("words"), (i == F.size("ps") - 1).alias("last")))
    plain = ps.select(F.explode(tagged).alias("p")).select("p.*").groupBy("words").agg(F.count("*").alias("n"), F.count_if("last").alias("ends"))
    plain = cut_lineage(plain)
    masked = plain.where(F.col("words").rlike(r"\p{N}")).groupBy(F.concat(F.lit("#"), _masked(F.col("words"))).alias("words"))
    both = plain.unionByName(masked.agg(F.sum("n").alias("n"), F.sum("ends").alias("ends")))
    return cut_lineage(both.select("words", _joined(F.col("words")).alias("phrase"), "n", "ends"))


def _prefix(phrase: Column, length: Column) -> Column:
    p = F.substring(phrase, F.lit(1), length)
    return F.when(length <= DENSE, p).otherwise(F.sha2(p, 256))


def prefix_self_join(weights: DataFrame) -> DataFrame:
    """(phrase, tail, n, ends, ext, mid, stands) of the phrases in which a value ends and that begin longer phrases.

    Of the `ext` longer copies, `mid` go on inside a word and `stands` after a whole word; `tail` is the last word.
    Phrases beyond DENSE characters are cut only at lengths at which a value with the same first
    DENSE characters ends; these lengths are a table that is joined, not a list on the driver.
    """
    length = F.length("phrase")
    start = F.substring("phrase", 1, DENSE)
    edges = F.aggregate(F.split("words", " "), F.array(F.lit(0)), lambda a, w: F.concat(a, F.array(F.element_at(a, -1) + F.length(w))))
    cuts = weights.where((F.col("ends") > 0) & (length > DENSE)).select(start.alias("start"), length.alias("l")).distinct()
    cols = ["phrase", "n", edges.alias("edges")]
    near = weights.where(length > 1).select(*cols, F.explode(F.sequence(F.lit(1), F.least(length - 1, F.lit(DENSE)))).alias("l"))
    far = weights.where(length > DENSE + 1).select(*cols, start.alias("start")).join(cuts, "start").where(F.col("l") < length).drop("start")
    parts = near.unionByName(far)
    edge = F.array_contains(F.col("edges"), F.col("l"))
    inside = ~edge & F.substring(F.col("phrase"), F.col("l"), F.lit(2)).rlike(r"^\p{L}{2}$")
    ext = parts.groupBy(_prefix(F.col("phrase"), F.col("l")).alias("key")).agg(
        F.sum("n").alias("ext"), F.sum(F.when(inside, F.col("n")).otherwise(0)).alias("mid"), F.sum(F.when(edge, F.col("n")).otherwise(0)).alias("stands")
    )
    tail = F.max(F.substring_index("words", " ", -1)).alias("tail")
    ends = weights.groupBy("phrase").agg(tail, F.sum("n").alias("n"), F.sum("ends").alias("ends")).where("ends > 0")
    return ends.withColumn("key", _prefix(F.col("phrase"), length)).join(ext, "key").drop("key")


def standing_words(weights: DataFrame) -> DataFrame:
    """(tail, known): in how many places a word stands where a value doesn't end."""
    words = weights.select("n", "ends", F.split("words", " ").alias("ws")).select("n", "ends", F.size("ws").alias("k"), F.posexplode("ws").alias("i", "tail"))
    inner = F.when(F.col("i") == F.col("k") - 1, F.col("n") - F.col("ends")).otherwise(F.col("n"))
    return words.groupBy("tail").agg(F.sum(inner).alias("known")).where("known > 0")


def weighed_phrases(weights: DataFrame, ratio: float = RATIO, masked_ratio: float = MASKED_RATIO) -> DataFrame:
    """(phrase, n, ext, bound, cut): phrases that end values and begin longer ones, and whether they end values only where these were cut."""
    found = prefix_self_join(weights).join(standing_words(weights), "tail", "left")
    bound = F.when(F.col("phrase").startswith("#"), masked_ratio).otherwise(ratio)
    rare = F.col("n") <= F.col("ext") * bound
    noise = F.col("mid") * ratio
    whole = F.col("n") - F.col("ends") + F.col("stands") > noise
    word = (F.coalesce("known", F.lit(0)) > noise) & (F.col("ends") > F.col("mid"))
    return cut_lineage(found.select("phrase", "n", "ext", bound.alias("bound"), (rare | ((F.col("mid") > 0) & ~whole & ~word)).alias("cut")))


def _flagged(rows: DataFrame, column: str, phrases: DataFrame, flag: str) -> DataFrame:
    """Rows with `flag` (true or null) by whether their phrase is one of a staged table's."""
    count, width = measured(phrases)
    hit = phrases.select(F.col("phrase").alias(column), F.lit(True).alias(flag))
    if count <= BROADCAST_ROWS and width <= BROADCAST_BYTES:
        return rows.join(F.broadcast(hit), column, "left")
    if not count:
        return rows.withColumn(flag, F.lit(None).cast("boolean"))
    held = rows.join(hit.select(column), column, "left_semi")
    others = rows.join(hit.select(column), column, "left_anti").withColumn(flag, F.lit(None).cast("boolean"))
    return join_hot(held, hit, [column], [c for c in held.columns if c != column]).unionByName(others)


def limit_phrases(rows: DataFrame, weighed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((s, l) of field limits, phrases that are cut there): both staged. `rows` are (v, p, m, l, s, cut): folded value, last
    phrase, its masked form, length, source, and whether the row's own evidence says it was cut."""
    # Distinct values by their hash: eight bytes are shuffled for each, and one collision changes a count by one.
    values = rows.groupBy("s", "l", F.xxhash64("v").alias("h")).agg(F.max(F.col("cut").cast("int")).alias("cut"))
    spots = values.groupBy("s", "l").agg(F.count("*").alias("all"), F.sum("cut").alias("bad"))
    spots = cut_lineage(spots.where((F.col("bad") >= SPIKE_VALUES) & (F.col("bad") >= F.col("all") * SPIKE)).select(F.col("s").alias("at_s"), F.col("l").alias("at_l")))
    at = rows.where("not cut").join(broadcast_if_small(spots), F.col("s").eqNullSafe(F.col("at_s")) & (F.col("l") == F.col("at_l")), "left_semi")
    here = at.select("v", F.explode(F.array("p", "m")).alias("phrase")).where("phrase is not null").distinct().groupBy("phrase").agg(F.count("*").alias("here"))
    ok = (F.col("n") - F.col("here")) <= F.col("ext") * F.col("bound")
    return spots, cut_lineage(here.join(weighed.where("not cut"), "phrase").where(ok).select("phrase"))


def truncated(df: DataFrame, value: str = "description", ratio: float = RATIO, masked_ratio: float = MASKED_RATIO, source: str | None = "source") -> DataFrame:
    """The rows of `df` whose value was cut off. Without a column `source` all rows are of one source."""
    source = source if source in df.columns else None
    rows, names = folded_rows(df, value, source)
    weighed = weighed_phrases(phrase_weights(rows.select(F.col(names["v"]).alias("v"))), ratio, masked_ratio)
    cut = cut_lineage(weighed.where("cut").select("phrase"))
    c1, c2, c3, c4, c5, at_s, at_l = fresh_names(rows, "_c1", "_c2", "_c3", "_c4", "_c5", "_at_s", "_at_l")
    p, m = names["p"], names["m"]
    plain, masked = ~F.col("phrase").startswith("#"), F.col("phrase").startswith("#")
    rows = _flagged(_flagged(rows, p, cut.where(plain), c1), m, cut.where(masked), c2)
    own = F.col(c1).isNotNull() | F.col(c2).isNotNull() | F.col(names["d"])
    spots, more = limit_phrases(rows.select(*[F.col(names[k]).alias(k) for k in ("v", "p", "m", "l", "s")], own.alias("cut")), weighed)
    if not more.isEmpty():
        rows = _flagged(_flagged(rows, p, more.where(plain), c3), m, more.where(masked), c4)
        limit = spots.select(F.col("at_s").alias(at_s), F.col("at_l").alias(at_l), F.lit(True).alias(c5))
        rows = rows.join(broadcast_if_small(limit), F.col(names["s"]).eqNullSafe(F.col(at_s)) & (F.col(names["l"]) == F.col(at_l)), "left")
        own = own | (F.col(c5).isNotNull() & (F.col(c3).isNotNull() | F.col(c4).isNotNull()))
    return rows.where(own).select(*df.columns)


def truncation_rates(df: DataFrame, value: str = "description", source: str = "source") -> DataFrame:
    """(source, n_rows, n_cut): how often each source cuts, over rows with a value."""
    found = truncated(df.select(source, value), value, source=source).groupBy(source).agg(F.count("*").alias("c")).withColumnRenamed(source, "_s")
    total = df.where(F.col(value).isNotNull()).groupBy(source).agg(F.count("*").alias("n_rows"))
    out = total.join(found, F.col(source).eqNullSafe(F.col("_s")), "left")
    return out.select(source, "n_rows", F.coalesce("c", F.lit(0)).alias("n_cut"))
