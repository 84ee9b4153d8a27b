"""Fields of documents: asked for, united, judged, located, rated, looked up on the page, and kept with their trail."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ids
from ..functions import text as T
from ..functions import trust as R
from ..functions import values as V
from ..operators import audit, evidence, extract, scd2, search
from ..sources import config, providers
from ..sources.snapshots import Store
from .common import KEY, chained, live, replaced, stamped

WIDE, TALL, TRAIL = "gold_fields", "gold_evidence", "gold_audit"
MODES = ("off", "verify", "correct")


def _extractor(requests: list[str], _format: str) -> list[str]:
    return providers.rule_extractor(requests)


class Plan:
    """The field configuration and how each field is to be asked for."""

    def __init__(self, spark, entries: list[dict]):
        rows = config.fields(spark, entries).withColumn("strategy", extract.strategy(F.lower(F.coalesce("type", F.lit("string"))), F.col("source"), F.col("extraction_strategy"))).orderBy("position").collect()
        self.fields = [r.asDict(recursive=True) | {"type": (r["type"] or "string").lower()} for r in rows]  # as many as are configured
        self.groups: dict[str, list[dict]] = {}
        for f in self.fields:
            self.groups.setdefault(f["strategy"], []).append(f)

    def table(self, some: list[dict] | None = None) -> Column:
        """The fields as an array of structs (field_name, kind, strategy, pattern, reduce)."""
        lit = lambda v: F.lit(v).cast("string")
        return F.array(*[F.struct(lit(f["field_name"]).alias("field_name"), lit(f["type"]).alias("kind"), lit(f["strategy"]).alias("extraction_strategy"), lit(V.pattern_that_compiles(f["validation_pattern"])).alias("pattern"), lit(f["reduce"]).alias("reduce"), F.lit(f["position"]).alias("position")) for f in (self.fields if some is None else some)])

    def coerced(self, value: Column, quoted: Column) -> Column:
        """A value as its field declares it (columns field_name and kind)."""
        out = V.coerce(value, F.col("kind"), quoted)
        for f in self.fields:
            if f["type"] == "struct_list":
                out = F.when(F.col("field_name") == f["field_name"], V.coerce_structs(value, [(i["name"], i["type"]) for i in f["item_fields"] or ()])).otherwise(out)
        return out

    def validated(self) -> Column:
        out = V.validate(F.col("value"), F.col("kind"), F.col("pattern"))
        for f in self.fields:
            if f["type"] == "struct_list":
                out = F.when(F.col("field_name") == f["field_name"], V.validate_structs(F.col("value"), [i["name"] for i in f["item_fields"] or ()])).otherwise(out)
        return out


def todo(store: Store, code: str, forced=None) -> tuple[DataFrame, DataFrame]:
    """(active, pending): live texts with the version that their fields are to have, and those whose version isn't current without an error."""
    text = live(store, "silver_text").where("extracted_text is not null")
    if "di_quality_flag" not in text.columns:
        text = text.withColumn("di_quality_flag", F.lit(None).cast("string"))
    active = chained(text.select(KEY, "file_name", "content_hash", "extracted_text", "di_quality_flag", F.col("version_id").alias("silver_version_id")), "silver_version_id", code)
    pending = scd2.pending(active, store.read(WIDE), error="extraction_error") if store.exists(WIDE) else active
    return active, scd2.apply_force(active, pending, forced, KEY)


def retrieved(store: Store, docs: DataFrame, fields: list[dict], k: int) -> DataFrame:
    """(relative_path, context, chunk_ids, n): what the questions of a group of fields find in each document, in chunk order."""
    asked = F.array(*[F.struct(F.lit(f["field_name"]).alias("field_name"), F.lit(f["question"]).alias("question")) for f in fields])
    questions = docs.select(KEY, F.explode(asked).alias("q")).select(KEY, "q.*")
    index = store.read("chunk_index")
    hits = search.hybrid(index, store.read("postings"), providers.embed(questions, "question"), "field_name", "chunk_id", KEY, k)
    union = search.group_union(hits.join(index.select("chunk_id", "chunk_index", "text"), "chunk_id"), [KEY], "chunk_id").join(index.select("chunk_id", "text"), "chunk_id")
    listed = F.array_sort(F.collect_list(F.struct("pos", "chunk_id", "text")))
    each = union.groupBy(KEY).agg(listed.alias("c"))
    text = F.array_join(F.filter(F.transform("c", lambda c: c["text"]), lambda t: F.coalesce(t, F.lit("")) != ""), "\n\n")
    return each.select(KEY, text.alias("context"), F.to_json(F.transform("c", lambda c: c["chunk_id"])).alias("chunk_ids"), F.size("c").alias("n"))


def contexts(store: Store, docs: DataFrame, plan: Plan, k: int = 8, least: int = 3) -> DataFrame:
    """(relative_path, strategy, part, context, chunk_ids): one row for each call; part 0 is the only call of its group, others are chunks."""
    none = F.lit(None).cast("string")
    out = None
    for name, fields in plan.groups.items():
        whole = docs.select(KEY, F.lit(name).alias("strategy"), F.lit(0).alias("part"), F.col("extracted_text").alias("context"), none.alias("chunk_ids"))
        rows = whole
        if name == "tables" and store.exists("silver_tables"):
            rendered = extract.render_tables(live(store, "silver_tables").join(docs.select(KEY), KEY, "left_semi"), KEY)
            rows = whole.join(rendered, KEY, "left").withColumn("context", F.coalesce("rendered", "context")).drop("rendered")
        elif name == "map_reduce" and store.exists("silver_chunks"):
            chunks = live(store, "silver_chunks").select(KEY, "chunk_index", "chunk_id", "text").join(docs.select(KEY), KEY, "left_semi")
            listed = chunks.groupBy(KEY).agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("chunk_index", "chunk_id"))), lambda c: c["chunk_id"])).alias("chunk_ids"))
            parts = chunks.join(listed, KEY).select(KEY, F.lit(name).alias("strategy"), (F.col("chunk_index") + 1).alias("part"), F.coalesce("text", F.lit("")).alias("context"), "chunk_ids")
            rows = parts.unionByName(whole.join(chunks.select(KEY).distinct(), KEY, "left_anti"))
        elif name in ("rag", "retrieve_classify") and store.exists("chunk_index"):
            found = retrieved(store, docs, fields, k).withColumnRenamed("context", "found").withColumnRenamed("chunk_ids", "found_ids")
            enough = F.coalesce(F.col("n") >= least, F.lit(False))
            rows = whole.join(found, KEY, "left").select(KEY, "strategy", "part", F.when(enough, F.col("found")).otherwise(F.col("context")).alias("context"), F.when(enough, F.col("found_ids")).alias("chunk_ids"))
        out = rows if out is None else out.unionByName(rows)
    return out


def ask(df: DataFrame, plan: Plan, provider=_extractor, most: int = 3_000_000) -> DataFrame:
    """contexts() with ok, payload and error of each call."""
    by_group = lambda make: F.create_map(*[x for g, fs in plan.groups.items() for x in (F.lit(g), F.lit(json.dumps(make(fs))))])[F.col("strategy")]
    questions = by_group(lambda fs: [{k: f[k] for k in ("field_name", "type", "question")} for f in fs])
    patterns = by_group(lambda fs: {f["field_name"]: f["question"] for f in fs})
    formats = by_group(extract.response_schema)
    request = F.to_json(F.struct(F.from_json(questions, "array<struct<field_name:string,type:string,question:string>>").alias("fields"), F.from_json(patterns, "map<string,string>").alias("patterns"), F.substring("context", 1, most).alias("text"), formats.alias("format")))
    return providers.call_with_fallback(df.withColumn("request", request).drop("context"), "request", provider).drop("request")


def united(answers: DataFrame, plan: Plan, reduce: providers.Provider = providers.first_spellings) -> tuple[DataFrame, DataFrame]:
    """(values, errors): (relative_path, field columns, value, quote, chunk_ids), and (relative_path, error) of documents with a call that failed."""
    errors = answers.where("not ok").groupBy(KEY).agg(F.array_join(F.array_sort(F.collect_list("error")), "; ").alias("error"))
    good = answers.where("ok").join(errors, KEY, "left_anti")
    mine = F.filter(plan.table(), lambda f: f["extraction_strategy"] == F.col("strategy"))
    each = good.select(KEY, "part", "chunk_ids", "payload", F.explode(mine).alias("f")).select(KEY, "part", "chunk_ids", "payload", "f.*").withColumn("p", extract.parse(F.col("payload"), F.col("field_name")))
    each = each.withColumns({"value": plan.coerced(F.col("p.value"), F.col("p.quoted")), "quote": F.col("p.quote")}).drop("p", "payload")
    fields = ["field_name", "kind", "extraction_strategy", "pattern", "reduce", "position"]
    parts = each.where("part > 0")
    items = F.coalesce(V.json_list(F.col("value")), F.when(F.col("value").isNotNull(), F.array("value")), F.array().cast("array<string>"))
    keys = [KEY, *fields]
    lists = extract.union_partials(parts.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c in ("pattern", "reduce") else F.col(c) for c in keys], F.col("part").alias("chunk_index"), items.alias("items"), "quote"), keys)
    lists = lists.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in ("pattern", "reduce")}).join(parts.groupBy(KEY, "field_name").agg(F.first("chunk_ids").alias("chunk_ids")), [KEY, "field_name"])
    lists = lists.withColumn("value", extract.items_json(F.col("value")))
    if any((f["reduce"] or "").lower() == "llm" for f in plan.fields):
        asked = F.coalesce((F.lower("reduce") == "llm") & F.col("value").isNotNull(), F.lit(False))
        request = F.to_json(F.struct("field_name", F.from_json("value", "array<string>").alias("items")))
        told = providers.call(lists.where(asked).withColumn("request", request), "request", reduce)
        cleaned = F.from_json("payload", "items array<string>")["items"]
        told = told.withColumn("value", F.coalesce(F.when(F.col("ok"), extract.items_json(F.filter(cleaned, lambda x: ~T.is_blank(x)))), F.col("value")))  # a call that fails leaves the union
        lists = lists.where(~asked).unionByName(told.select(lists.columns))
    return each.where("part = 0").select(*lists.columns).unionByName(lists), errors


def judged(values: DataFrame, docs: DataFrame, judge: providers.Provider | None, most: int = 3_000_000) -> DataFrame:
    """values with judge_verdict, judge_rationale and judge_error: one call for each document with all its fields; no judge, no verdicts."""
    none = F.lit(None).cast("string")
    if judge is None:
        return values.withColumns({"judge_verdict": none, "judge_rationale": none, "judge_error": none})
    asked = F.map_from_entries(F.collect_list(F.struct("field_name", F.struct("value", "quote"))))
    calls = values.groupBy(KEY).agg(asked.alias("fields")).join(docs.select(KEY, "extracted_text"), KEY).select(KEY, F.to_json(F.struct("fields", F.substring("extracted_text", 1, most).alias("text")), {"ignoreNullFields": "false"}).alias("request"))
    told = providers.call(calls, "request", judge).select(KEY, F.from_json("payload", "map<string,string>").alias("verdicts"), F.col("error").alias("judge_error"))
    mine = F.try_element_at("verdicts", F.col("field_name"))
    return values.join(told, KEY, "left").withColumns({"judge_verdict": F.get_json_object(mine, "$.verdict"), "judge_rationale": F.get_json_object(mine, "$.rationale")}).drop("verdicts")


def rated(values: DataFrame, docs: DataFrame, blocks: DataFrame | None, plan: Plan, with_judge: bool, threshold: float = 0.85, longest: int = 600, most: int = 3_000_000) -> DataFrame:
    """Evidence rows: located in the text, validated, with the confidence of their block, and with trust and steps."""
    # a document's text goes with its fields as one row, not with each of them through a shuffle
    fields = values.groupBy(KEY).agg(F.collect_list(F.struct(*[c for c in values.columns if c != KEY])).alias("fs"))
    spread = docs.select(KEY, "extracted_text", F.col("di_quality_flag").alias("document_flag")).join(fields, KEY).select(KEY, F.col("extracted_text").alias("text"), "document_flag", (F.length("extracted_text") > most).alias("truncated"), F.explode("fs").alias("f")).select(KEY, "text", "document_flag", "truncated", "f.*")
    located = evidence.locate(spread, threshold).drop("text")
    if blocks is None:
        sure = located.withColumns({"conf_min": F.lit(None).cast("double"), "page": F.lit(None).cast("int")})
    else:
        sure = evidence.block_confidence(located, blocks, KEY, ["field_name"])
    sure = sure.withColumnRenamed("conf_min", "evidence_confidence").withColumnRenamed("page", "evidence_page").withColumn("type_validation", plan.validated())
    return evidence.finalize(sure, with_judge, longest)


def looked_up(rows: DataFrame, docs: DataFrame, plan: Plan, mode: str, judge: providers.Provider | None, page=providers.page_of_text, verify=providers.rule_verify, correct=providers.rule_correct, most_fields: int = 5, scan: int = 2, threshold: float = 0.85, longest: int = 600) -> DataFrame:
    """rows after a look at the page of those that need one.

    verify: what the page says of the value goes into source_verified. correct: of the least certain
    fields of a document (most_fields at most, all if negative) those that the page doesn't confirm
    are read anew; a new value is located in the text again, judged again in one call for its
    document, and counts as found on the page if it isn't in the text but the judge agrees.
    """
    none = F.lit(None).cast("string")
    blank = rows.withColumns({"vision_verdict": none, "vision_rationale": none, "vision_action": F.lit("none"), "value_source": F.lit("model_text"), "original_value": none})
    if mode == "off":
        return blank
    picked = evidence.to_escalate(blank, KEY, "position", most_fields if mode == "correct" else None, "evidence_confidence").drop("rank")
    if mode == "verify":
        picked = picked.where("value is not null")
    rest = blank.join(picked.select(KEY, "field_name"), [KEY, "field_name"], "left_anti")
    texts = docs.select(KEY, F.col("extracted_text").alias("text"))
    # pages to try in order; the first that can be had counts
    wanted = picked.select(KEY, "field_name", F.posexplode(R.pages_to_read(F.col("evidence_page"), F.lit(None).cast("array<int>"), F.lit(scan))).alias("turn", "page"))
    had = providers.call(wanted.select(KEY, "page").distinct().join(texts, KEY).select(KEY, "page", F.to_json(F.struct("text", "page")).alias("request")), "request", page).where("ok").select(KEY, "page", F.col("payload").alias("page_text"))
    shown = wanted.join(had, [KEY, "page"]).groupBy(KEY, "field_name").agg(F.min_by(F.struct("page", "page_text"), "turn").alias("shown")).select(KEY, "field_name", F.col("shown.page").alias("used_page"), "shown.page_text")
    seen = picked.join(shown, [KEY, "field_name"])
    rest = rest.unionByName(picked.join(shown, [KEY, "field_name"], "left_anti"))

    with_judge = judge is not None
    answer = F.from_json("payload", "verdict string, rationale string")
    asked = providers.call(seen.where("value is not null").withColumn("request", F.to_json(F.struct(F.col("page_text").alias("page"), "value"))), "request", verify)
    verdict = F.coalesce(F.when(answer["verdict"].isin("confirmed", "contradicted"), answer["verdict"]), F.lit("unclear"))
    checked = asked.withColumns({"vision_verdict": verdict, "vision_rationale": answer["rationale"], "vision_action": F.lit("verify")})
    checked = evidence.retrusted(checked.withColumn("source_verified", R.fold_verdict(F.col("vision_verdict"), F.col("source_verified"))), with_judge)
    checked = checked.withColumn("steps", F.concat("steps", F.array(evidence.step("vision_verify", F.col("vision_verdict"), F.col("vision_rationale")))))
    columns = blank.columns
    if mode == "verify":
        return rest.unionByName(checked.select(columns))

    more = [*columns, "used_page", "page_text"]
    open_ = checked.select(more).unionByName(seen.where("value is null").select(more))
    sure = F.coalesce(F.col("vision_verdict") == "confirmed", F.lit(False))
    patterns = F.create_map(*[x for f in plan.fields for x in (F.lit(f["field_name"]), F.lit(f["question"]))])
    read = providers.call(open_.where(~sure).withColumn("request", F.to_json(F.struct(F.col("page_text").alias("page"), patterns[F.col("field_name")].alias("pattern")))), "request", correct)
    new = F.from_json("payload", "value string, evidence string, verdict string, rationale string")
    read = read.withColumn("new", new).withColumn("taken", F.coalesce(F.col("ok") & (F.col("new.verdict") == "correct") & (F.col("new.value") != ""), F.lit(False)))
    tried = F.concat("steps", F.array(evidence.step("vision_correct", F.lit("unclear"), F.coalesce("new.rationale", "vision_rationale"))))
    left = read.where("not taken").withColumn("steps", F.when(F.col("ok"), tried).otherwise(F.col("steps")))
    taken = read.where("taken").withColumns({"original_value": F.col("value"), "value": F.col("new.value"), "value_source": F.lit("vision"), "vision_action": F.lit("correct"), "vision_rationale": F.coalesce("new.rationale", "vision_rationale"), "evidence_page": F.col("used_page"), "quote": F.col("new.evidence"), "source_verified": F.lit("confirmed")})
    taken = evidence.locate(taken.drop("match_type").join(texts, KEY), threshold).drop("text").withColumn("evidence_text", F.substring("quote", 1, longest))
    taken = taken.withColumn("steps", F.concat("steps", F.array(evidence.step("vision_correct", F.lit("correct"), F.col("vision_rationale")))))
    again = taken.drop("judge_verdict", "judge_rationale").withColumnRenamed("judge_error", "first_error")
    again = judged(again, docs, judge).drop("judge_error").withColumnRenamed("first_error", "judge_error").join(taken.select(KEY, "field_name", F.col("judge_verdict").alias("old_verdict"), F.col("judge_rationale").alias("old_rationale")), [KEY, "field_name"])
    again = again.withColumns({"judge_rationale": F.when(F.col("judge_verdict").isNotNull(), F.col("judge_rationale")).otherwise(F.col("old_rationale")), "judge_verdict": F.coalesce("judge_verdict", "old_verdict")})
    again = again.withColumn("match_type", F.when((F.col("match_type") == "not_found") & (F.col("judge_verdict") == "correct"), "vision_page").otherwise(F.col("match_type")))
    again = evidence.retrusted(again, with_judge)
    again = again.withColumn("steps", F.concat("steps", F.array(evidence.step("rejudge", F.col("judge_verdict"), F.col("judge_rationale")))))
    for part in (open_.where(sure), left, again):
        rest = rest.unionByName(part.select(columns))
    return rest


def wide(values: DataFrame, docs: DataFrame, errors: DataFrame, plan: Plan) -> DataFrame:
    """One row for each document with a typed column for each field; documents with an error have that instead."""
    kinds = extract.wide_schema(plan.fields)
    tall = extract.wide(values.select(KEY, "field_name", "value"), [KEY], list(kinds))
    typed = tall.select(KEY, *[F.col(f"`{n}`").try_cast(k).alias(n) for n, k in kinds.items()])
    known = docs.select("version_id", KEY, "file_name", "content_hash", "code_hash")
    return known.join(errors.withColumnRenamed("error", "extraction_error"), KEY, "left").join(typed, KEY, "left")


#: The columns of the evidence table, beside its versions and dates.
EVIDENCE = (
    "field_name extraction_strategy retrieved_chunk_ids value evidence_text match_type type_validation judge_verdict judge_rationale judge_error evidence_confidence evidence_page "
    "source_verified vision_verdict vision_rationale vision_action value_source original_value trust truncated"
).split()


def extracted(store: Store, docs: DataFrame, plan: Plan, provider=_extractor, judge: providers.Provider | None = providers.rule_judge_fields, reduce: providers.Provider = providers.first_spellings, mode: str = "off", **vision) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(values, errors, evidence rows) of documents (relative_path, extracted_text, di_quality_flag); answers of models are staged, so that they are asked once."""
    if mode not in MODES:
        raise ValueError(f"{mode} isn't one of {MODES}")
    answers = store.staged(ask(contexts(store, docs, plan), plan, provider))
    values, errors = united(answers, plan, reduce)
    values = store.staged(values.withColumnRenamed("chunk_ids", "retrieved_chunk_ids"))
    blocks = live(store, "silver_blocks").select(KEY, "block_index", "conf_min", "page", "text") if store.exists("silver_blocks") else None
    verdicts = store.staged(judged(values, docs, judge))
    rows = rated(verdicts, docs, blocks, plan, judge is not None)
    rows = rows if mode == "off" else store.staged(rows)
    return values, errors, looked_up(rows, docs, plan, mode, judge, **vision)


def run(store: Store, entries: list[dict], code: str, now: Column, audited: str = "gated", forced=None, **how) -> int:
    """Ask for the fields of new versions and commit the wide table, the evidence and the trail together."""
    plan = Plan(store.spark, entries)
    active, pending = todo(store, code, forced)
    docs = store.staged(pending)
    values, errors, rows = extracted(store, docs, plan, **how)
    versions = docs.select(KEY, "version_id", "file_name")
    rows = store.staged(rows.join(versions, KEY))
    ids_ = lambda df: df.withColumn("evidence_id", ids.evidence_id(F.col("version_id"), F.col("field_name")))
    tall = stamped(ids_(rows).select("evidence_id", "version_id", KEY, "file_name", *EVIDENCE), now)
    whole = wide(values, docs, errors, plan).withColumn("valid_from", now)
    if store.exists(WIDE):
        whole = scd2.tombstone(scd2.merge(store.read(WIDE), whole, KEY), active, KEY, now)
    else:
        whole = scd2.fresh(whole)
    good = docs.join(errors, KEY, "left_anti")
    trail = trails(rows, audited).withColumn("created_at", now)
    done = store.commit(append={TRAIL: trail} if audited != "off" else None, **{WIDE: whole, TALL: replaced(store, TALL, tall, good, active, now)})
    store.clear()
    return done


def trails(rows: DataFrame, mode: str) -> DataFrame:
    """The audit rows of evidence rows (with steps): all steps of fields that something happened to, the last step of the others (gated)."""
    told = rows.withColumn("interesting", audit.interesting(F.col("vision_action") != "none", F.col("judge_verdict"), F.col("trust")))
    logged = audit.log(told, ["version_id", KEY, "file_name", "field_name"], mode)
    return logged.withColumn("audit_id", ids.audit_id(F.col("version_id"), F.col("field_name"), F.col("stage"), F.col("step_seq")))


def current_trail(store: Store) -> DataFrame:
    """The last step of each field of the live versions."""
    return audit.terminal(store.read(TRAIL), ["version_id", "field_name"], live(store, TALL).select("version_id").distinct())
