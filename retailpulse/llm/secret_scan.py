"""Multipart secret scan with DataFrame functions only.

Three kinds of span stand on their own (base kinds); three weak kinds count only beside their
complement. A credential has an identifier, a secret and perhaps an endpoint:

========  ======  ==========================================================
assign    secret  a value of 12 or more characters given to a secret's name
access    id      an access key identifier of 18 or more characters
hex       secret  16 or more hexadecimal digits
ident     id      a value given to a user's or client's name        (weak)
opaque    secret  a mixed token of 24 or more characters             (weak)
endpoint  where   a URL, or a value given to a host's name           (weak)
========  ======  ==========================================================

A weak identifier is reported when a secret starts within ``SCOPE`` characters, a weak secret
when an identifier does, and an endpoint when both do. The parts are found by interval joins:
positions are dealt into bins of the scope's width, each part meets its own and the two
neighbouring bins, and a left semi join asks only whether a partner exists, so no pairs are
made. ``credentials`` then names, for every secret beside an identifier, the nearest parts it
belongs to. A text yields positions only where a pattern matches; nothing of a text is shuffled.

Positions are code points, end exclusive. They come from the lengths of the matches and of the
text between them, so the scan needs no code outside Spark.

Defined cases: a null or empty text has no spans; rows that repeat an id and a text get the
same result each; a null id is allowed; an empty table gives no rows; other columns are not
read (``scan``) or kept as they are (``redact``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, written

SCOPE = 300
MASK = "[SECRET]"

# The base patterns. kind -> (pattern, group that holds the value, least length)
BASE = {
    "assign": (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
               r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
WEAK = {
    "ident": (r"(?i:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)"
              r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]+)", 1, 3),
    "opaque": (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[a-z0-9+/_=-]*[A-Z])"
               r"(?=[A-Z0-9+/_=-]*[a-z])[A-Za-z0-9+/_=-]{24,}", 0, 24),
    "endpoint": (r"(?i:https?|jdbc:[a-z0-9]+|postgres|mysql|mongodb|redis|amqps?)://[^\s\"'<>]+"
                 r"|(?i:host(?:_?name)?|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+"
                 r"(?::[0-9]+)?", 0, 4),
}
KINDS = list(BASE) + list(WEAK)
IDENTIFIERS, SECRETS = ("access", "ident"), ("assign", "hex", "opaque")


def _matches(text: Column, kind: str) -> Column:
    """(gap, size, value) lengths of every match: what lies between it and the match before,
    the match, and its value, which ends it."""
    pattern, group, _ = {**BASE, **WEAK}[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern)
    return F.transform(found, lambda m, i: F.struct(
        F.length(F.get(gaps, i)).cast("long").alias("gap"), F.length(m).cast("long").alias("size"),
        F.length(F.get(values, i)).cast("long").alias("value")))


def _key(docs: DataFrame) -> Column:
    """Names a document's id and text; rows that repeat both share it."""
    return F.md5(F.concat_ws("\u0000", F.coalesce(F.col("doc_id").cast("string"), F.lit("\u0001")),
                             F.col("text")).cast("binary"))


def _candidates(docs: DataFrame) -> DataFrame:
    """key, kind, start, value_start, end: every match of every pattern, base or weak."""
    none = F.array().cast("array<struct<gap:bigint,size:bigint,value:bigint>>")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(_key(docs).alias("key"), text.alias("text"))
    # weak kinds are looked for only where a complement can exist at all
    rows = rows.withColumns({
        "assign": _matches(F.col("text"), "assign"),
        "access": F.when(F.contains("text", F.lit("AKIA")), _matches(F.col("text"), "access"))
        .otherwise(none),
        "hex": _matches(F.col("text"), "hex"),
        "ident": _matches(F.col("text"), "ident")})
    some = lambda kinds: F.greatest(*[F.size(k) for k in kinds], F.lit(0)) > 0
    rows = rows.withColumn("opaque", F.when(some(["access", "ident"]),
                                            _matches(F.col("text"), "opaque")).otherwise(none))
    rows = rows.withColumn("endpoint", F.when(
        some(["access", "ident"]) & some(["assign", "hex", "opaque"]),
        _matches(F.col("text"), "endpoint")).otherwise(none))

    def tagged(kind):
        return F.transform(kind, lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("n"), m["gap"].alias("gap"),
            m["size"].alias("size"), m["value"].alias("value")))

    # the outer form: a filter on the arrays would run every pattern twice
    rows = rows.select("key", F.explode_outer(F.flatten(F.array(*map(tagged, KINDS)))).alias("m"))
    rows = rows.select("key", "m.*").where("kind IS NOT NULL").distinct()
    so_far = Window.partitionBy("key", "kind").orderBy("n")
    end = F.sum(F.col("gap") + F.col("size")).over(so_far)
    least = F.create_map(*[F.lit(x) for k, (_, _, n) in {**BASE, **WEAK}.items() for x in (k, n)])
    return (rows.withColumn("end", end).where(F.col("value") >= least[F.col("kind")])
            .select("key", "kind", (F.col("end") - F.col("size")).alias("start"),
                    (F.col("end") - F.col("value")).alias("value_start"), "end"))


def _near(parts: DataFrame, kinds: tuple[str, ...], scope: int) -> DataFrame:
    """key, bin, at: starts of the kinds, in their own and the neighbouring bins."""
    own = F.floor(F.col("start") / scope)
    return parts.where(F.col("kind").isin(*kinds)).select(
        F.col("key"), F.explode(F.array(own - 1, own, own + 1)).alias("bin"),
        F.col("start").alias("at"))


def spans(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """key, kind, start, value_start, end of all reported spans; ``key`` as of ``_key``."""
    parts = written(_candidates(docs), "secret-parts")      # scanned once; read by every join
    binned = parts.withColumn("bin", F.floor(F.col("start") / scope))

    def beside(rows, kinds):
        other = _near(parts, kinds, scope).alias("o")
        rows = rows.alias("r")
        return rows.join(other, (F.col("r.key") == F.col("o.key")) & (F.col("r.bin") == F.col("o.bin"))
                         & (F.abs(F.col("r.start") - F.col("o.at")) <= scope), "left_semi")

    of = lambda kind: binned.where(F.col("kind") == kind)
    base = binned.where(F.col("kind").isin(*BASE))
    # a weak identifier and a weak secret complement each other
    linked = [beside(of("ident"), SECRETS), beside(of("opaque"), IDENTIFIERS),
              beside(beside(of("endpoint"), IDENTIFIERS), SECRETS)]
    out = base
    for rows in linked:
        out = out.unionByName(rows)
    return out.drop("bin")


def _by_document(found: DataFrame) -> DataFrame:
    """key, spans: sorted by start, then kind as listed."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    one = F.struct("start", order[F.col("kind")].alias("rank"), "end", "value_start", "kind")
    return found.groupBy("key").agg(F.array_sort(F.collect_list(one)).alias("spans"))


PART = ("start", "end", "kind")


def _with_nearest(rows: DataFrame, others: DataFrame, name: str, scope: int) -> DataFrame:
    """rows with the part of ``others`` whose start is nearest to the secret's within the scope
    (ties: the smaller start, then kind), or null. Spans of a kind do not overlap, so a secret
    meets a number of parts that the scope bounds."""
    own = F.floor(F.col("start") / scope)
    near = others.select(F.col("key").alias("_key"),
                         F.explode(F.array(own - 1, own, own + 1)).alias("_bin"),
                         F.struct(*PART).alias("_part"))
    far = F.abs(F.col("secret.start") - F.col("_part.start"))
    joined = rows.join(near, (F.col("key") == F.col("_key"))
                       & (F.floor(F.col("secret.start") / scope) == F.col("_bin")) & (far <= scope), "left")
    best = F.min(F.when(F.col("_part").isNotNull(), F.struct(far.alias("far"), "_part")))
    return joined.groupBy(*rows.columns).agg(best["_part"].alias(name))


def credentials(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """key, secret, identifier, endpoint (structs of start, end, kind) from the reported spans:
    every secret that has an identifier within the scope, with the nearest one and, if there is
    one, the nearest endpoint."""
    rows = found.where(F.col("kind").isin(*SECRETS)).select("key", F.struct(*PART).alias("secret"))
    rows = _with_nearest(rows, found.where(F.col("kind").isin(*IDENTIFIERS)), "identifier", scope)
    return _with_nearest(rows.where("identifier IS NOT NULL"),
                         found.where("kind = 'endpoint'"), "endpoint", scope)


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, spans (start, end, value_start, kind) and credentials (secret, identifier,
    endpoint; see ``credentials``), by the secret's place, for every row."""
    reported = written(spans(docs, scope), "secret-spans")
    found = _by_document(reported)
    linked = credentials(reported, scope).groupBy("key").agg(F.array_sort(F.collect_list(
        F.struct("secret", "identifier", "endpoint"))).alias("credentials"))
    found = found.join(linked, "key", "left")
    rows = docs.select("doc_id", _key(docs).alias("key")).join(found, "key", "left")
    none = lambda c: F.array().cast(found.schema[c].dataType)
    return rows.select("doc_id", F.transform(
        F.coalesce("spans", none("spans")), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            s["value_start"].alias("value_start"), s["kind"].alias("kind"))).alias("spans"),
        F.coalesce("credentials", none("credentials")).alias("credentials"))


def listed(spans_: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def listed_credentials(credentials_: Column) -> Column:
    """identifier+secret+endpoint of the credentials, each as in ``listed``, comma-joined."""
    def one(p):
        return F.when(p.isNotNull(), F.concat_ws(":", p["kind"], p["start"].cast("string"), p["end"].cast("string")))
    return F.array_join(F.transform(credentials_, lambda c: F.concat_ws(
        "+", one(c["identifier"]), one(c["secret"]), one(c["endpoint"]))), ",")


def redact(docs: DataFrame, scope: int = SCOPE, mask: str = MASK) -> DataFrame:
    """All rows and columns; the values of all reported spans give way to ``mask`` in ``text``."""
    key, found_ = fresh(docs, "key", "found")
    found = _by_document(spans(docs, scope)).select(F.col("key").alias(key), F.col("spans").alias(found_))
    rows = docs.withColumn(key, _key(docs)).join(found, key, "left")
    text = F.col("text")

    def put(acc, s):
        begin = F.greatest(s["value_start"], acc["at"])
        kept = F.substr(text, (acc["at"] + 1).cast("int"), (begin - acc["at"]).cast("int"))
        new = F.when(s["value_start"] >= acc["at"], F.lit(mask)).otherwise("")
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            F.concat(acc["out"], kept, new).alias("out"), s["end"].alias("at")))

    by_value = F.array_sort(F.transform(f"`{found_}`", lambda s: F.struct(
        s["value_start"].alias("value_start"), s["end"].alias("end"))))
    masked = F.aggregate(
        by_value, F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")), put,
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"),
                                                  F.length(text))))
    masked = F.when(F.col(f"`{found_}`").isNull(), text).otherwise(masked)
    return rows.select(*[masked.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
