"""Secrets in every version of every file, scanning each content once per rule version.

Contents are addressed by their SHA-256. A ledger holds what is known of a (content, rule,
rule version); only pairs it lacks are scanned, at one place of each content, and findings are
joined back to all places that hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import handed_over, release
from .shared import FILTER_BITS, content, row_filter, with_pass

#: Kind, version, pattern, group whose length counts, least length of that group.
#: The last two patterns hold their least length themselves: a run shorter than it contains no
#: longer one, so nothing changes by leaving short runs unmatched.
RULES = (
    ("assign", 1,
     r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     2, 8),
    ("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", 1, r"[0-9a-f]{32,}", 0, 32),
)
SPANS = "array<struct<start:int,end:int>>"
LEDGER = f"blob string, rule string, rule_version int, spans {SPANS}"


def found_spans(text: str, pattern: str, group: int, least: int) -> Column:
    """Start and end of the matches whose group is long enough, in code points.

    Matches are found leftmost and without overlap before the short ones are dropped. Their
    places come from the lengths of the pieces between them.
    """
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    whole = f"regexp_extract_all({text}, '{quoted}', 0)"
    counted = f"regexp_extract_all({text}, '{quoted}', {group})"
    pieces = f"split({text}, '{quoted}', -1)"
    walk = f"""
        filter(aggregate(
            zip_with(zip_with({whole}, {counted}, (w, g) -> struct(length(w) AS w, length(g) AS g)),
                     slice({pieces}, 1, size({whole})),
                     (m, p) -> struct(m.w AS w, m.g AS g, length(p) AS p)),
            struct(0 AS at, CAST(array() AS array<struct<start:int,end:int,g:int>>) AS spans),
            (a, m) -> struct(
                a.at + m.p + m.w AS at,
                array_append(a.spans, struct(a.at + m.p AS start, a.at + m.p + m.w AS end, m.g AS g))
                    AS spans),
            a -> a.spans), s -> s.g >= {least})"""
    spans = f"transform({walk}, s -> struct(s.start AS start, s.end AS end))"
    return F.expr(
        f"IF({text} RLIKE '{quoted}', {spans}, CAST(array() AS {SPANS}))"
    )


def blob(text: str = "text") -> Column:
    """Address of a content; a null text counts as empty."""
    return F.sha2(content(text), 256)


def scan(
    versions: DataFrame, ledger: DataFrame | None = None, text: str = "text",
    path: str = "doc_id", rules=RULES, filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Findings of every place, and the ledger with what was new.

    Places: path, blob, and a map from rule to spans, one row per row of ``versions``. ``path``
    may repeat; if it does with different texts, each text is a version of its own.
    Ledger: blob, rule, rule_version, spans, empty spans included, so that a clean content is not
    scanned again. A rule with a new version is scanned anew, the others are not.
    """
    spark = versions.sparkSession
    known = ledger if ledger is not None else spark.createDataFrame([], LEDGER)
    places = handed_over(versions.select(F.col(path).alias("_path"), blob(text).alias("blob")), "places")
    wanted = F.array(*[
        F.struct(F.lit(kind).alias("rule"), F.lit(version).alias("rule_version"))
        for kind, version, *_ in rules
    ])
    firsts = places.groupBy("blob").agg(F.min("_path").alias("_path"))
    unseen = handed_over(
        firsts.select("blob", "_path", F.inline(wanted))
        .join(known, ["blob", "rule", "rule_version"], "left_anti"),
        "unseen",
    )
    texts = versions.select(F.col(path).alias("_path"), content(text).alias("_text"))
    filters = []
    for kind, *_ in rules:
        filters.append(handed_over(
            row_filter(unseen.where(F.col("rule") == kind), F.col("_path"), filter_bits), "to-scan"
        ))
        texts = with_pass(texts, filters[-1], F.col("_path"), f"_go_{kind}", filter_bits)
    none = F.lit(None).cast(SPANS)
    results = texts.where(" OR ".join(f"_go_{kind}" for kind, *_ in rules)).select(
        blob("_text").alias("blob"),
        F.array(*[
            F.struct(
                F.lit(kind).alias("rule"), F.lit(version).alias("rule_version"),
                F.when(F.col(f"_go_{kind}"), found_spans("_text", *how)).otherwise(none).alias("spans"),
            )
            for kind, version, *how in rules
        ]).alias("_found"),
    )
    new = handed_over(
        results.select("blob", F.inline("_found")).where("spans IS NOT NULL")
        # rows that only seemed to be among the filter's, and rows that repeat a path and its text
        .join(unseen, ["blob", "rule", "rule_version"], "left_semi")
        .dropDuplicates(["blob", "rule", "rule_version"]),
        "scanned",
    )
    release(unseen, *filters)
    whole = known.select(*new.columns).unionByName(new)
    current = F.broadcast(spark.createDataFrame(
        [(kind, version) for kind, version, *_ in rules], "rule string, rule_version int"
    ))
    findings = handed_over(
        whole.join(current, ["rule", "rule_version"]).where("size(spans) > 0")
        .groupBy("blob")
        .agg(F.map_from_entries(F.collect_list(F.struct("rule", "spans"))).alias("spans")),
        "findings",
    )
    found = places.join(findings, "blob", "left").select(
        F.col("_path").alias(path), "blob",
        F.coalesce("spans", F.expr(f"CAST(map() AS map<string,{SPANS}>)")).alias("spans"),
    )
    return found, whole


def span_columns(found: DataFrame, rules=RULES) -> DataFrame:
    """Adds the number of spans of each kind, and all spans as text, ``kind:start:end`` in order
    of their start, then of the kinds as listed."""
    def placed(kind: str, at: int) -> Column:
        spans = F.coalesce(F.col("spans")[kind], F.expr(f"CAST(array() AS {SPANS})"))
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(at).alias("at"), s["end"].alias("end"),
            F.lit(kind).alias("kind"),
        ))

    each = [placed(kind, at) for at, (kind, *_) in enumerate(rules)]
    counts = {
        f"n_{kind}": F.coalesce(F.array_size(F.col("spans")[kind]), F.lit(0)).cast("bigint")
        for kind, *_ in rules
    }
    ordered = F.array_sort(F.concat(*each))
    spelled = F.array_join(
        F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    return found.withColumns({**counts, "_spelled": spelled}).drop("spans").withColumnRenamed(
        "_spelled", "spans"
    )
