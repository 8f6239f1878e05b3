"""Secret scans: base patterns, and multipart credential linking.

Three base kinds are reported wherever they match. Three weaker kinds are parts of a
credential, and reported only where complementary parts lie in one scope, that is,
with at most ``scope`` code points between them:

- secret: 40 characters of a base64 alphabet with a digit, a capital and a small
  letter, also straight after '=' (KEY=VALUE files, URL parameters); needs an access identifier (access, ident) or an endpoint in scope;
- ident: the value of a user, client or account id; needs a secret part (assign,
  hex, secret) in scope;
- endpoint: a URL or a host with a port; needs both an access identifier and a
  secret part in scope.

A weak secret that a base span covers is not reported again.

The parts of each text are found by regular expressions in the scan's projection
(guarded by cheaper tests, so most texts cost one look). Their offsets are prefix
sums, over a window, of the lengths between and of the matches. The interval join of
parts within scopes is two ordered passes over a document's parts (nearest part of
each sort before and after), never pairs. Only such narrow rows are shuffled; texts
stay where they are. DataFrame functions only.

Defined cases: a null text is empty and has no span; null ids and repeated rows are
kept, a row each; parts that start at one place come in the order of KINDS; texts of
any length are read whole, by patterns that neither nest nor look back over a run; an
empty table gives no row; other columns, of any name, are ignored.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.llm.common import bounded_broadcast, fresh, table, written

# The base patterns, as the contract states them.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}+"  # whole runs, as with [0-9a-f]+ and a length of 32 or more
# The weak parts.
SECRET = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
IDENT = r"""(?i:(?:client|account|user|access)_?(?:key_?)?(?:id|name))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{4,})"""
# Starts only where a run of labels does, and keeps what it took: long runs cost one pass and no stack.
ENDPOINT = r"""https?://[^\s"'<>]{4,}|(?<![A-Za-z0-9.-])(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}:[0-9]{2,5}\b"""

KINDS = ("assign", "access", "hex", "secret", "ident", "endpoint")
BASE = KINDS[:3]
SCOPE = 300
#: Rows and spans that a broadcast of found secrets may have.
MOST_BROADCAST = 1 << 20

PART = "array<struct<kind:int,pos:int,gap:int,size:int,good:boolean>>"


def _parts(text: Column, kind: int, pattern: str, guard: Column, good) -> Column:
    """(kind, pos, gap before, size, good) of each match in order; empty where ``guard`` is false."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    zipped = F.transform(
        F.arrays_zip(found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("g")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("size"), good(x["m"]).alias("good")),
    )
    return F.when(guard, zipped.cast(PART)).otherwise(F.array().cast(PART))


def all_parts(text: Column) -> Column:
    marked = text.contains("=") | text.contains(":")
    value = lambda m: F.length(F.regexp_extract(m, f"^{ASSIGN}$", 2)) >= 8
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    every = lambda m: F.lit(True)
    return F.concat(
        _parts(text, 0, ASSIGN, marked & text.rlike("(?i)password|passwd|secret|token|api_?key"), value),
        _parts(text, 1, ACCESS, text.contains("AKIA"), lambda m: F.length(m) >= 16),
        _parts(text, 2, HEX, text.rlike("[0-9a-f]{32}"), every),
        _parts(text, 3, SECRET, text.rlike(SECRET), mixed),
        _parts(text, 4, IDENT, marked & text.rlike(IDENT), every),
        _parts(text, 5, ENDPOINT, text.contains(":") & text.rlike(ENDPOINT), every),
    )


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, content (hash of the text), spans, a row a document.

    spans: array of (start, kind, end, seen); seen is the end of the earlier spans.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("content"), F.monotonically_increasing_id().alias("row"), all_parts(text).alias("parts"))
    key = ["doc_id", "content", "row"]
    parts = rows.select(*key, F.explode_outer("parts").alias("p")).select(*key, "p.*").repartition(*key)
    # all windows and the last grouping lie within a document, so none of them shuffles again
    lengths = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy(*key, "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.withColumn("end", lengths).withColumn("start", F.col("end") - F.col("size"))
    parts = parts.withColumn("kind", F.when(F.col("good"), F.col("kind")))  # no kind: no part, but its document stays
    ident, secret, endpoint = F.col("kind").isin(1, 4), F.col("kind").isin(0, 2, 3), F.col("kind") == 5
    before = Window.partitionBy(*key).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*key).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)

    def near(sort: Column) -> Column:
        last = F.max(F.when(sort, F.col("end"))).over(before)
        following = F.min(F.when(sort, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last <= scope, F.lit(False)) | F.coalesce(following - F.col("end") <= scope, F.lit(False))

    parts = parts.select(*key, "kind", "start", "end", near(ident).alias("by_ident"), near(secret).alias("by_secret"), near(endpoint).alias("by_endpoint"), F.max(F.when(F.col("kind") < 3, F.col("end"))).over(before).alias("covered"))
    linked = (
        F.when(F.col("kind") < 3, F.lit(True))
        .when(F.col("kind") == 3, (F.col("by_ident") | F.col("by_endpoint")) & (F.coalesce(F.col("covered"), F.lit(0)) <= F.col("start")))
        .when(F.col("kind") == 4, F.col("by_secret"))
        .when(F.col("kind") == 5, F.col("by_ident") & F.col("by_secret"))
    )
    seen = F.coalesce(F.max(F.when(F.col("linked"), F.col("end"))).over(before), F.lit(0))
    span = F.when(F.col("linked"), F.struct("start", "kind", "end", "seen"))
    return parts.withColumn("linked", linked).withColumn("seen", seen).groupBy(*key).agg(F.sort_array(F.collect_list(span)).alias("spans")).drop("row")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    of = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(of) - F.size(F.array_remove(of, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, scope: int = SCOPE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span that ``scan`` reports replaced by ``mask``; the columns stay.

    The scan runs when this is called. Its spans are sent to the texts while they are
    few (MOST_BROADCAST); beyond that both sides are shuffled.
    """
    of, content, spans, mine = (fresh(docs, c) for c in ("spans_of", "spans_content", "spans_found", "spans_mine"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    some = scan(docs, scope).filter(F.size("spans") > 0).groupBy(F.col("doc_id").alias(of), F.col("content").alias(content)).agg(F.first("spans").alias(spans))
    some = written(some, "secret-spans")
    size = some.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size(spans)), F.lit(0))).first()[0]
    some = bounded_broadcast(some, MOST_BROADCAST) if size <= MOST_BROADCAST else some
    joined = docs.withColumn(mine, F.xxhash64(text)).join(some, F.col("doc_id").cast("long").eqNullSafe(F.col(of)) & (F.col(mine) == F.col(content)), "left")
    # a span within an earlier one leaves nothing of its own to mask
    pieces = F.transform(spans, lambda s: F.when(s["start"] >= s["seen"], F.concat(F.substring(text, s["seen"].cast("int") + 1, (s["start"] - s["seen"]).cast("int")), F.lit(mask))).otherwise(F.lit("")))
    rest = F.substring(text, F.array_max(F.transform(spans, lambda s: s["end"])).cast("int") + 1, F.length(text))
    hidden = F.concat(F.array_join(pieces, ""), rest)
    out = joined.withColumn("text", F.when(F.col(spans).isNotNull(), hidden).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def op10_query(spark, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents")))
