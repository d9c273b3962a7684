"""Secret scans over all versions of all paths, through a ledger of blobs.

Every version is addressed by the hash of its content. The ledger holds, for each blob and each version of a rule, the spans
found; a scan reads only pairs that the ledger lacks, appends them, and joins findings back to all paths that have or
had the blob. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapvault.session import scratch_dir, settled
from snapvault.sources.hadoop import Folders


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``hints``: lower-case strings of which a text that matches has one; none: always tried.

    ``group`` and ``least``: matches whose group is shorter are dropped after the search.
    """

    kind: str
    pattern: str
    hints: tuple[str, ...] = ()
    group: int = 0
    least: int = 0
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The patterns of the base kinds.
BASE = (
    Rule(
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        group=2,
        least=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", ("akia",), least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", ("private key-----",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", ("eyj",)),
)
RULES = BASE + MORE
SPANS = "array<struct<start:bigint,end:bigint>>"


def content_address(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _portions(values: Column, size: int = 512) -> Column:
    """An array in parts. A fold copies what it has gathered at every step, so it gathers within a part, then the parts."""
    starts = lambda xs: F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(size))
    return _bound(values, lambda xs: F.transform(starts(xs), lambda i: F.slice(xs, i, size)))


def find_spans(text: Column, rule: Rule) -> Column:
    """Spans of the rule's leftmost non-overlapping matches, in code points; what lies between the matches gives their
    places."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), 0)
    told = F.regexp_extract_all(text, F.lit(rule.pattern), rule.group) if rule.group else matches
    between = F.split(text, rule.pattern, -1)
    found = F.transform(
        F.arrays_zip(matches.alias("m"), told.alias("g"), F.slice(between, 1, F.size(matches)).alias("b")),
        lambda x: F.struct(
            F.length(x["b"]).cast("bigint").alias("gap"),
            F.length(x["m"]).cast("bigint").alias("size"),
            (F.length(x["g"]) >= rule.least).alias("ok"),
        ),
    )
    def step(s, x):
        start = s["at"] + x["gap"]
        span = F.array(F.struct(start.alias("start"), (start + x["size"]).alias("end")))
        return F.struct((start + x["size"]).alias("at"), F.when(x["ok"], F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    def portion(s, xs):
        return _bound(
            F.aggregate(xs, F.struct(s["at"].alias("at"), F.array().cast(SPANS).alias("spans")), step),
            lambda done: F.struct(done["at"].alias("at"), F.concat(s["spans"], F.array(done["spans"])).alias("spans")),
        )

    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(f"array<{SPANS}>").alias("spans"))
    return F.aggregate(_portions(found), state, portion, lambda s: F.flatten(s["spans"]))


class Ledger:
    """Findings by blob and rule version, one folder a scan, below ``path`` on storage that all executors share."""

    schema = f"blob string, rule string, spans {SPANS}"

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        """One row a pair, also where two scans ran side by side."""
        folders = Folders(self.spark)
        if not folders.exists(self.path) or folders.first_child(self.path) is None:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self.path)
        return found.dropDuplicates(["blob", "rule"])

    def append(self, findings: DataFrame, label: str) -> None:
        findings.write.parquet(f"{self.path.rstrip('/')}/{label}")

    def empty(self) -> bool:
        folders = Folders(self.spark)
        return not folders.exists(self.path) or folders.first_child(self.path) is None


def scan_unseen(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the pairs of ``versions``' blobs (``blob``, ``text``) and rules that the ledger lacks; gives the new rows.

    Equal texts meet before the shuffle, so thousands of copies are one blob and one scan.
    """
    blobs = versions.groupBy("blob").agg(F.any_value("text").alias("text"))
    names = F.array(*[F.lit(r.name) for r in rules])
    if ledger.empty():
        blobs = blobs.withColumn("todo", names)
    else:
        done = ledger.read().groupBy("blob").agg(F.collect_set("rule").alias("done"))
        blobs = blobs.join(done, "blob", "left").withColumn("todo", F.array_except(names, F.coalesce("done", F.array())))
        blobs = blobs.filter(F.size("todo") > 0)
    text = F.col("text")
    # One look for the hints of all rules; most texts have none.
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    blobs = blobs.withColumn("lower", lower)
    rows = []
    for rule in rules:
        hinted = reduce(lambda a, b: a | b, [F.contains("lower", F.lit(h)) for h in rule.hints]) if rule.hints else text.rlike(rule.pattern)
        todo = F.array_contains("todo", rule.name)
        spans = F.when(todo & hinted, find_spans(text, rule)).otherwise(F.array().cast(SPANS))
        rows.append(F.when(todo, F.struct(F.lit(rule.name).alias("rule"), spans.alias("spans"))))
    found = blobs.select("blob", F.explode(F.array_compact(F.array(*rows))).alias("x"))
    return found.select("blob", "x.rule", "x.spans")


def scan_secrets(
    docs: DataFrame,
    *,
    path: str = "doc_id",
    text: str = "text",
    rules: tuple[Rule, ...] = RULES,
    ledger: str | None = None,
) -> DataFrame:
    """Every row of ``docs`` (``path``, ``blob``) with ``findings``: spans of all kinds by start, then kind as in ``rules``.

    ``docs`` holds versions: a path may come many times, with many texts, and stays one row each time. Null text: empty. A
    null path is kept. ``ledger`` is a folder that outlives the call; without one, a folder of this run. No rows: no rows.
    A path column called ``blob`` or ``findings`` keeps its name; the column of that name made here gets a ``_`` behind it.
    """
    spark = docs.sparkSession
    book = Ledger(spark, ledger or scratch_dir(spark, "secret-ledger"))
    versions = docs.select(
        F.col(f"`{path}`").alias("path"),
        content_address(F.col(f"`{text}`")).alias("blob"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    book.append(scan_unseen(versions.select("blob", "text"), book, rules), scratch_dir(spark, "scan").rsplit("/", 1)[1])
    numbers = {r.name: i for i, r in enumerate(rules)}
    known = book.read().filter(F.col("rule").isin(list(numbers)) & (F.size("spans") > 0))
    number = reduce(lambda c, r: c.when(F.col("rule") == r, numbers[r]), list(numbers)[1:], F.when(F.col("rule") == rules[0].name, 0))
    known = known.withColumn("no", number).select(
        "blob",
        F.transform(
            "spans", lambda s: F.struct(s["start"].alias("start"), F.col("no").alias("no"), s["end"].alias("end"))
        ).alias("spans"),
    )
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    known = known.groupBy("blob").agg(F.sort_array(F.flatten(F.collect_list("spans"))).alias("spans"))
    named = F.transform(
        "spans", lambda s: F.struct(F.get(kinds, s["no"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )
    found = versions.select("path", "blob").join(known, "blob", "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    own = [name + "_" if name == path else name for name in ("blob", "findings")]
    return found.select(F.col("path").alias(path), F.col("blob").alias(own[0]), F.coalesce(named, none).alias(own[1]))


def redact(text: Column, findings: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every run of overlapping findings replaced by ``mark``; findings are sorted by start.

    Places in a string are found by walking from its start, so the text is cut behind each part of the findings."""
    strings = "array<string>"

    def step(rest, base):
        def one(s, x):
            before = F.substring(rest, (s["at"] - base + 1).cast("int"), (x["start"] - s["at"]).cast("int"))
            out = F.when(x["start"] >= s["at"], F.concat(s["out"], F.array(before, F.lit(mark)))).otherwise(s["out"])
            return F.struct(F.greatest(s["at"], x["end"]).alias("at"), out.alias("out"))

        return one

    def portion(s, xs):
        gathered = F.aggregate(xs, F.struct(s["at"].alias("at"), F.array().cast(strings).alias("out")), step(s["rest"], s["at"]))
        return _bound(
            gathered,
            lambda done: F.struct(
                done["at"].alias("at"),
                F.substring(s["rest"], (done["at"] - s["at"] + 1).cast("int"), F.length(s["rest"])).alias("rest"),
                F.concat(s["out"], F.array(F.array_join(done["out"], ""))).alias("out"),
            ),
        )

    state = F.struct(F.lit(0).cast("bigint").alias("at"), text.alias("rest"), F.array().cast(strings).alias("out"))
    cut = F.aggregate(_portions(findings), state, portion, lambda s: F.concat(F.array_join(s["out"], ""), s["rest"]))
    return F.when(F.size(findings) > 0, cut).otherwise(text)


def _told(findings: Column) -> Column:
    return F.array_join(
        F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _count(kind: str) -> Column:
    return F.size(F.filter("findings", lambda s: s["kind"] == kind)).cast("bigint")


def query(spark, sf_dir):
    from snapvault.llm.common import read

    docs, book = read(spark, sf_dir, "documents"), scratch_dir(spark, "secret-ledger")
    scan_secrets(docs, rules=BASE, ledger=book)
    found = scan_secrets(docs, ledger=book)  # the base pairs stand in the ledger, so only the other rules are scanned
    kinds = [r.kind for r in BASE]
    return found.select(
        "doc_id",
        *[_count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(_told(F.filter("findings", lambda s: s["kind"].isin(*kinds))), 256).alias("base_sha256"),
        _told(F.col("findings")).alias("spans"),
    )


def _sql_rule(number: int, rule: Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {number} AS no, regexp_extract_all(t, '{pattern}', 0) AS ms,
  regexp_extract_all(t, '{pattern}', {rule.group}) AS gs, string_split_regex(t, '{pattern}') AS ps, {rule.least} AS least FROM d"""


SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({" UNION ALL ".join(_sql_rule(i, r) for i, r in enumerate(RULES))}),
u AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM m),
s AS (SELECT doc_id, kind, no, CAST(list_sum(list_transform(ps[1:i], lambda x: length(x)))
  + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a, length(ms[i]) AS n
  FROM u WHERE length(gs[i]) >= least),
g AS (SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
  count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, no) FILTER (WHERE no < {len(BASE)}) AS base,
  string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, no) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
"""
