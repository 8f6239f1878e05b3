"""Entity resolution and search over names; designs of our own."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.functions import text as X
from lexforge.sources.shared import written


def key(name: Column) -> Column:
    """Lower case, letters and digits with one space between words."""
    return X.squeezed(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " "))


def sorted_key(name: Column) -> Column:
    return F.array_join(F.array_sort(F.split(key(name), " ")), " ")


def trigrams(name: Column) -> Column:
    """The set of three-character pieces of ' name '."""
    pieces = lambda s: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(s) - 2), lambda i: F.substring(s, i, F.lit(3))))
    return X.bind(F.concat(F.lit("  "), key(name), F.lit(" ")), pieces)


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of trigram sets."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)).cast("double")


def exact(names: DataFrame, query: str) -> DataFrame:
    spark = names.sparkSession
    wanted = spark.range(1).select(key(F.lit(query)).alias("_k"))
    return names.withColumn("_k", key(F.col("name"))).join(F.broadcast(wanted), "_k", "left_semi").drop("_k")


def fuzzy(names: DataFrame, query: str, least: float = 0.3) -> DataFrame:
    """Names by trigram similarity to the query, then by edit distance. Each is scored once, where it lies after what ``names`` does."""
    q = F.lit(query)
    scored = X.once(X.once(names, _t=trigrams(F.col("name"))), score=similarity(F.col("_t"), trigrams(q))).drop("_t").filter(F.col("score") >= least)
    return scored.withColumn("distance", F.levenshtein(key(F.col("name")), key(q)))


def phonetic(names: DataFrame, query: str) -> DataFrame:
    code = lambda x: F.array_join(F.transform(F.split(key(x), " "), lambda w: F.soundex(w)), " ")
    return names.filter(code(F.col("name")) == code(F.lit(query)))


def index(docs: DataFrame, text: str = "text") -> DataFrame:
    """term, file_id, tf: a file's terms, counted in its own row before the shuffle."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return docs.select("file_id", F.explode(words).alias("term")).groupBy("term", "file_id").agg(F.count(F.lit(1)).alias("tf"))


def full_text(docs: DataFrame, query: str, text: str = "text") -> DataFrame:
    """file_id, score: sum over the query's terms of tf * ln(1 + n / df)."""
    terms = sorted({t for t in re.split(r"[^\w]+|_", query.lower()) if t})
    # only rows with one of the terms leave the scan
    some = index(docs.filter(F.lower(text).rlike("|".join(map(re.escape, terms)) or "(?!)")), text).filter(F.col("term").isin(terms))
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    df = some.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return some.join(F.broadcast(df), "term").join(F.broadcast(n)).groupBy("file_id").agg(F.round(F.sum(F.col("tf") * F.log1p(F.col("n") / F.col("df"))), 6).alias("score"))


def route(query: str) -> str:
    """file for an id, exact for a quoted or full name, phonetic for one word, else fuzzy."""
    q = query.strip()
    if re.fullmatch(r"[A-Za-z]*[0-9]{3,}[A-Za-z0-9_-]*", q):
        return "file"
    if q.startswith('"') and q.endswith('"'):
        return "exact"
    return "phonetic" if re.fullmatch(r"[A-Za-z]+", q) else "fuzzy"


def search(names: DataFrame, query: str) -> DataFrame:
    """By the query's tier; an exact search without a hit goes on to a fuzzy one."""
    tier = route(query)
    if tier == "file":
        return names.filter(F.col("file_id").cast("string") == query.strip())
    if tier == "phonetic":
        return phonetic(names, query)
    if tier == "exact":
        return exact(names, query.strip('"'))
    found = exact(names, query)
    return found if found.limit(1).count() else fuzzy(names, query).drop("score", "distance")


def similar_pairs(names: DataFrame, least: float = 0.5) -> DataFrame:
    """a, b, score of different names at a trigram similarity of ``least``.

    A pair that similar shares one of the first n - ceil(least * n) + 1 trigrams of
    either name in one order of all trigrams (rarest first), so only these are joined.
    The different names and their trigrams are written once, when this is called: their
    number decides what follows, not how often each occurs.
    """
    sets = written(X.once(names.select("name").distinct(), t=trigrams(F.col("name"))), "trigrams")
    df = sets.select(F.explode("t").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("df"))
    ranked = sets.select("name", F.size("t").alias("n"), F.explode("t").alias("g")).join(df, "g")
    order = ranked.groupBy("name", "n").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("o"))
    prefix = order.select("name", F.explode(F.slice("o", F.lit(1), (F.col("n") - F.ceil(F.col("n") * least) + 1).cast("int"))).alias("p")).select("name", "p.g")
    pairs = prefix.withColumnRenamed("name", "a").join(prefix.withColumnRenamed("name", "b"), "g").filter("a < b").select("a", "b").distinct()
    both = pairs.join(sets.withColumnsRenamed({"name": "a", "t": "ta"}), "a").join(sets.withColumnsRenamed({"name": "b", "t": "tb"}), "b")
    return both.select("a", "b", F.round(similarity(F.col("ta"), F.col("tb")), 6).alias("score")).filter(F.col("score") >= least)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node of each connected component, for the nodes of edges (a, b).

    Links a node's larger neighbours, then its smaller ones, to its least neighbour,
    until every node has one edge, to its root; the rounds grow with the logarithm of
    a component's size, and nothing bounds them. Each round is written to the shared folder.
    """
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while now.groupBy("a").count().filter("count > 1").limit(1).count() or now.join(now.select(F.col("b").alias("a")), "a", "left_semi").limit(1).count():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = written(small.filter("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def entities(spark: SparkSession, names: DataFrame, least: float = 0.6) -> DataFrame:
    """name, entity: exact keys, then sorted tokens, then connected components of similar names with fitting initials, each named by its least form."""
    base = names.select("name", sorted_key(F.col("name")).alias("k")).distinct()
    forms = base.groupBy("k").agg(F.min("name").alias("form"))
    pairs = similar_pairs(forms.select(F.col("form").alias("name")), least)
    initials = lambda c: F.array_sort(F.transform(F.split(key(F.col(c)), " "), lambda w: F.substring(w, 1, 1)))
    links = pairs.filter(F.size(F.array_intersect(initials("a"), initials("b"))) == F.least(F.size(initials("a")), F.size(initials("b")))).select("a", "b")
    roots = components(links).select(F.col("node").alias("form"), "root")
    return base.join(forms, "k").join(roots, "form", "left").select("name", F.coalesce("root", "form").alias("entity"))
