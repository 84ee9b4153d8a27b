"""How far a value can be trusted: categories, gates and escalation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCATED = ("exact", "normalized", "fuzzy", "vision_page")


def base_trust(match: Column, verdict: Column, judge_error: Column, judged: Column) -> Column:
    located = match.isin(*LOCATED)
    return (
        F.when(F.coalesce(judge_error, F.lit(False)), "review")
        .when(~judged | verdict.isNull(), F.when(located, "review").otherwise("unknown"))
        .when(verdict == "incorrect", "low")
        .when(verdict == "partial", "review")
        .when(verdict == "unverifiable", "unknown")
        .when(verdict == "correct", F.when(located, "high").otherwise("review"))
        .otherwise("review")
    )


def trust(value: Column, match: Column, verdict: Column, judge_error: Column, judged: Column, validation: Column, source: Column) -> Column:
    """unknown for no value; else the base, raised to high by a confirmed source, then held at review by a form or source that fails."""
    base = base_trust(match, verdict, judge_error, judged)
    raised = F.when((base == "review") & F.coalesce((verdict == "correct") & (source == "confirmed"), F.lit(False)), "high").otherwise(base)
    fails = F.coalesce(validation == "invalid", F.lit(False)) | F.coalesce(source == "low", F.lit(False))
    return F.when(value.isNull(), "unknown").when((raised == "high") & fails, "review").otherwise(raised)


def source_verified(document_flag: Column, confidence: Column, threshold: float = 0.7) -> Column:
    """low for a document that was read badly; null where nothing is known of the place; else by its confidence."""
    low = F.coalesce(document_flag == "low", F.lit(False)) | F.coalesce(confidence < threshold, F.lit(False))
    return F.when(low, "low").when(confidence.isNotNull(), "high")


def escalates(match: Column, trust_: Column, confidence: Column, document_flag: Column, threshold: float = 0.7) -> Column:
    """Whether the page itself should be looked at."""
    no = F.lit(False)
    return match.isin("fuzzy", "not_found") | trust_.isin("review", "low") | F.coalesce(confidence < threshold, no) | F.coalesce(document_flag == "low", no)


#: Ranks from the least certain on; names that aren't here count as review and na_null.
TRUST_RANKS = {"low": 0, "review": 1, "unknown": 2, "high": 3}
MATCH_RANKS = {"not_found": 0, "fuzzy": 1, "na_null": 2, "normalized": 3, "vision_page": 3, "exact": 4}


def _rank(column: Column, ranks: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for name, rank in ranks.items():
        out = F.when(column == name, rank).otherwise(out)
    return out


def uncertainty(match: Column, trust_: Column, confidence: Column) -> list[Column]:
    """Order by these for the least certain first."""
    return [_rank(trust_, TRUST_RANKS, 1), _rank(match, MATCH_RANKS, 2), F.coalesce(confidence, F.lit(1.0))]


def pages_to_read(evidence_page: Column, retrieved: Column, scan: Column) -> Column:
    """The evidence's page; else the distinct pages of retrieved chunks, best first; else the first pages up to scan."""
    found = F.array_distinct(F.filter(F.coalesce(retrieved, F.array().cast("array<int>")), lambda p: p.isNotNull()))
    return F.when(evidence_page.isNotNull(), F.array(evidence_page)).when(F.size(found) > 0, found).when(scan > 0, F.sequence(F.lit(1), scan)).otherwise(F.array().cast("array<int>"))


def fold_verdict(verdict: Column, current: Column) -> Column:
    return F.when(verdict == "confirmed", "confirmed").when(verdict == "contradicted", "low").otherwise(current)
