"""Queries: tokens, sequences, summaries, prompts, answers, embeddings and file round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohort_spark.catalog.common import (
    BASE_TIME, MINUTE_SQL, OBS_SQL, OUTCOMES_SQL, PANEL_SQL, SPLIT_SQL, VARIABLES, cols_sql, hourly_panel, minute_panel,
    observations, outcomes, round_sql, rounded, split_of,
)
from cohort_spark.catalog.registry import query
from cohort_spark.catalog.statistics import TARGET_SQL, metrics_sql, target
from cohort_spark.functions.answers import clean_llm_output, extract_score
from cohort_spark.functions.numeric import half_up
from cohort_spark.operators import prompts, sequences, summaries, vectors
from cohort_spark.operators.clients import HashingEmbedder, RuleClient, StatisticsEmbedder
from cohort_spark.operators.relate import expand_settings
from cohort_spark.session import scratch_path
from cohort_spark.sources import stages, tables
from cohort_spark.sources.observations import extract_entity_id, ingest_panel

# ---- tokens and sequences -------------------------------------------------------------------------------------------

TZV_SQL = f"""{PANEL_SQL}, {OUTCOMES_SQL}, scaled as (
  select entity_id, date_diff('microsecond', timestamp '{BASE_TIME}', ts) / 1e6 / (720 * 3600) as "T", label,
    {cols_sql("({c} - min({c}) over ()) / (max({c}) over () - min({c}) over ()) as {c}")}
  from panel left join outcomes using (entity_id)),
long as (select * from scaled unpivot ("V" for variable in ({", ".join(VARIABLES)})))"""


@query(
    "build_tzv",
    f"""with {TZV_SQL} select entity_id, {round_sql('"T"', 9)} as "T",
    (list_position([{", ".join(f"'{v}'" for v in VARIABLES)}], variable) - 1)::int as "Z", {round_sql('"V"')} as "V", label
    from long""",
)
def _(t):
    triples, _ = sequences.build_tzv(hourly_panel(t), outcomes(t), VARIABLES, BASE_TIME, 720)
    return rounded(rounded(triples, ["T"], 9), ["V"])


SEQ = ["click", "view"]


@query(
    "build_sequences",
    f"""with {PANEL_SQL}, {OUTCOMES_SQL}, s as (
      select entity_id, count(*)::int as length, {cols_sql("sum(coalesce({c}, 0)::float::double) as {c}", SEQ)}
      from panel group by entity_id)
    select entity_id, 0::bigint as segment, length, (select max(length) from s) as padded,
      {round_sql("click", 3)} as sum0, {round_sql("view", 3)} as sum1 from s join outcomes using (entity_id)""",
)
def _(t):
    built = sequences.build_sequences(hourly_panel(t), SEQ, outcomes(t), chunk_hours=None)
    return rounded(sequences.sequence_sums(built, 2), ["sum0", "sum1"], 3)


@query(
    "build_sequence_segments",
    f"""with {PANEL_SQL}, n as (select *, (row_number() over (partition by entity_id order by ts) - 1) // 24 as segment from panel)
    select entity_id, segment::bigint as segment, count(*)::int as length, 24 as padded,
      {cols_sql(round_sql("sum(coalesce({c}, 0)::float::double)", 3), SEQ).replace("+ 0.0, round", "+ 0.0 as sum0, round")} as sum1
    from n group by 1, 2""",
)
def _(t):
    built = sequences.build_sequences(hourly_panel(t), SEQ, pad_to=24, chunk_rows=200)
    return rounded(sequences.sequence_sums(built, 2), ["sum0", "sum1"], 3)


# ---- summaries --------------------------------------------------------------------------------------------------------

PEOPLE_SQL = """people as (select c_custkey as entity_id, (c_nationkey + 20)::double as "Age",
  (c_custkey % 2)::double as "Gender", round(abs(c_acctbal) / 100, 1) as "Weight" from customer)"""
TREND_SQL = f"""{MINUTE_SQL}, long as (select entity_id, ts, variable, value
    from minutes unpivot (value for variable in ({", ".join(VARIABLES)}))),
placed as (select *, row_number() over (partition by entity_id, variable order by ts) - 1 as place,
  count(*) over (partition by entity_id, variable) as n from long),
stats as (select entity_id, variable, count(*) as n, min(value) as low, max(value) as high, avg(value) as mean,
  arg_max(value, ts) as last, avg(value) filter (where place < n // 3) as m1,
  avg(value) filter (where place >= n // 3 and place < 2 * n // 3) as m2,
  avg(value) filter (where place >= 2 * n // 3) as m3 from placed group by entity_id, variable),
trends as (select *, case when n < 2 then 'unknown' when m1 < m2 and m2 < m3 then '↑' when m1 > m2 and m2 > m3 then '↓'
  when abs(m1 - m2) < 0.1 and abs(m2 - m3) < 0.1 then '→' else '~' end as trend from stats)"""


def reading_panel(t):
    people = t.customer.select(
        F.col("c_custkey").alias("entity_id"),
        (F.col("c_nationkey") + 20).cast("double").alias("Age"),
        (F.col("c_custkey") % 2).cast("double").alias("Gender"),
        F.round(F.abs("c_acctbal") / 100, 1).alias("Weight"),
    )
    return minute_panel(t).join(people, "entity_id", "left")


@query(
    "trend_labels",
    f"""with {TREND_SQL} select entity_id, variable, n, low, high, {round_sql("mean")} as mean, last, trend from trends""",
)
def _(t):
    return rounded(summaries.trend_labels(minute_panel(t), VARIABLES, chunk_rows=500), ["mean"])


TWO = "({x}::decimal(28, 2))::varchar"
LINES_SQL = f"""{TREND_SQL}, {PEOPLE_SQL}, lines as (
  select entity_id, string_agg('- ' || variable || ' ranged from ' || {TWO.format(x="low")} || ' to ' || {TWO.format(x="high")}
      || ', avg: ' || {TWO.format(x="last")} || ', last: ' || {TWO.format(x="last")}, chr(10) order by variable) as plain,
    string_agg('- ' || variable || ' ranged from ' || {TWO.format(x="low")} || ' to ' || {TWO.format(x="high")}
      || ', shows a trend of ' || trend || '. avg: ' || {TWO.format(x="last")} || ', last: ' || {TWO.format(x="last")}, chr(10)
      order by variable) filter (where n >= 3) as trend from trends group by entity_id),
texts as (select entity_id, 'Patient is a ' || "Age"::int || '-year-old ' || case when "Gender" = 1 then 'male' else 'female' end
    || '. Over the first 48 hours:' || coalesce(chr(10) || plain, '') as summary_statistical,
  'Patient is a ' || "Age"::int || '-year-old ' || case when "Gender" = 1 then 'male' else 'female' end || ', weights '
    || "Weight"::varchar || ' kg. Over the first 48 hours:' || coalesce(chr(10) || trend, '') as summary_trend
  from lines join people using (entity_id))"""


def all_summaries(t):
    return summaries.patient_summaries(reading_panel(t), outcomes(t), cols=VARIABLES)


@query(
    "patient_summaries",
    f"with {LINES_SQL}, {OUTCOMES_SQL} select entity_id, summary_statistical, summary_trend, label from texts left join outcomes using (entity_id)",
)
def _(t):
    return all_summaries(t)


@query("summary_statistical", f"with {LINES_SQL} select entity_id, summary_statistical from texts")
def _(t):
    return all_summaries(t).select("entity_id", "summary_statistical")


@query("summary_trend", f"with {LINES_SQL} select entity_id, summary_trend from texts")
def _(t):
    return all_summaries(t).select("entity_id", "summary_trend")


# ---- prompts and answers ------------------------------------------------------------------------------------------------

SHOTS_SQL = """train as (select doc_id, text, quality from documents join labels using (doc_id)),
shots as (select 'x' as one, trim(chr(10) from '### Examples' || chr(10) || string_agg('Input:' || chr(10) || text || chr(10)
    || 'Answer: ' || (quality * 9 + 1)::int || '/10', chr(10) || chr(10) order by md5('42:' || doc_id), doc_id)) as context
  from (select * from train order by md5('42:' || doc_id), doc_id limit 3))"""


def few_shots(t):
    train = t.documents.select("doc_id", "text").join(t.labels, "doc_id")
    return prompts.few_shot_context(train, "text", "quality", 3, 42, "score", "doc_id")


@query("few_shot_context", f"with {SHOTS_SQL} select context from shots")
def _(t):
    return few_shots(t)


@query(
    "build_prompt",
    f"""with {SHOTS_SQL} select conv_id, turn, 'Input:' || chr(10) || text || chr(10) || 'Answer:' as zero_shot,
    context || chr(10) || chr(10) || '### Task ' || chr(10) || 'Input:' || chr(10) || text || chr(10) || 'Answer:' as few_shot
    from conversations, shots""",
)
def _(t):
    from cohort_spark.plans.chunks import with_parameters

    rows = with_parameters(t.conversations, few_shots(t), "shots")
    return rows.select(
        "conv_id",
        "turn",
        prompts.user_prompt(F.col("text")).alias("zero_shot"),
        prompts.user_prompt(F.col("text"), F.col("shots.context")).alias("few_shot"),
    )


ANSWER_SQL = """answers as (select conv_id, turn, case turn % 4
  when 0 then '<think>' || role || chr(10) || turn || '</think> ANSWER : ' || text
  when 1 then ' Answer: ' || (conv_id % 15) || '/10 ' || role when 2 then text || ' high risk' else 'Not ' || role || ', it is unlikely' end as answer
  from conversations)"""


def answers(t):
    turn, role, text = F.col("turn"), F.col("role"), F.col("text")
    thought = F.concat(F.lit("<think>"), role, F.lit("\n"), turn.cast("string"), F.lit("</think> ANSWER : "), text)
    graded = F.concat(F.lit(" Answer: "), (F.col("conv_id") % 15).cast("string"), F.lit("/10 "), role)
    answer = (
        F.when(turn % 4 == 0, thought)
        .when(turn % 4 == 1, graded)
        .when(turn % 4 == 2, F.concat(text, F.lit(" high risk")))
        .otherwise(F.concat(F.lit("Not "), role, F.lit(", it is unlikely")))
    )
    return t.conversations.select("conv_id", "turn", answer.alias("answer"))


def _clean_sql(x: str) -> str:
    bare = f"regexp_replace({x}, '<think>.*?</think>', '', 'gis')"
    bare = f"regexp_replace({bare}, '\\banswer\\s*:\\s*', '', 'gi')"
    return f"regexp_replace({bare}, '^\\s+|\\s+$', '', 'g')"


@query("clean_llm_output", f"with {ANSWER_SQL} select conv_id, turn, {_clean_sql('answer')} as cleaned from answers")
def _(t):
    return answers(t).select("conv_id", "turn", clean_llm_output(F.col("answer")).alias("cleaned"))


NUMBER_SQL = "try_cast(nullif(regexp_extract(a, '(\\d+(\\.\\d+)?)', 1), '') as double)"


@query(
    "extract_score",
    f"""with {ANSWER_SQL}, c as (select conv_id, turn, {_clean_sql("lower(answer)")} as a from answers)
    select conv_id, turn, case when {NUMBER_SQL} is null then 0.5::double
      else least(greatest({NUMBER_SQL}, 1.0::double), 10.0::double) / 10 end as score,
    (case when {NUMBER_SQL} in (0, 1) then {NUMBER_SQL} when regexp_matches(a, 'yes|high|die|likely') then 1
      when regexp_matches(a, 'no|low|survive|unlikely') then 0 else 0.5 end)::double as flag,
    (case when {NUMBER_SQL} in (0, 1) then {NUMBER_SQL} when regexp_matches(a, '\\b(yes|high|die|likely)\\b') then 1
      when regexp_matches(a, '\\b(no|low|survive|unlikely)\\b') then 0 else 0.5 end)::double as strict_flag from c""",
)
def _(t):
    answer = F.col("answer")
    return answers(t).select(
        "conv_id",
        "turn",
        extract_score(answer, "score").alias("score"),
        extract_score(answer, "binary").alias("flag"),
        extract_score(answer, "binary", strict=True).alias("strict_flag"),
    )


# the stand-in client grades a prompt by its last number
PROMPT_SQL = f"""prompts as (select conv_id, turn, '{prompts.INPUT}' || text || '{prompts.ANSWER}' as prompt from conversations),
graded as (select *, regexp_extract_all(prompt, '\\d+(?:\\.\\d+)?') as numbers from prompts)"""


@query(
    "batch_infer",
    f"""with {PROMPT_SQL} select conv_id, turn, '<think>' || length(prompt) || ' characters</think> ' ||
      case when len(numbers) = 0 then 1 else least(10, 1 + floor(numbers[-1]::double / 10)::bigint) end as answer from graded""",
)
def _(t):
    rows = t.conversations.select(
        "conv_id", "turn", prompts.system_prompt("score").alias("system"), prompts.user_prompt(F.col("text")).alias("prompt")
    )
    return prompts.batch_infer(rows, RuleClient, ["conv_id", "turn"])


@query(
    "prompt_sweep",
    f"""with {LINES_SQL}, {TARGET_SQL}, bodies as (
      select label, text, regexp_extract_all(body, '\\d+(?:\\.\\d+)?')[-1]::double as number from (
        select label, summary_statistical, summary_trend from texts join target using (entity_id) where label is not null and {SPLIT_SQL} = 'c')
      unpivot (body for text in (summary_statistical, summary_trend))),
    graded as (select *, least(10, 1 + floor(number / 10)::bigint) as grade from bodies),
    scored as (select text, shots, mode, label, case when mode = 'binary' then (grade > 5)::int::double else grade / 10.0::double end as score
      from graded, (values ('few-shot'), ('zero-shot')) a(shots), (values ('binary'), ('score')) b(mode)), {metrics_sql("text, shots, mode")}""",
)
def _(t):
    rows = all_summaries(t).drop("label").join(target(t), "entity_id").where(F.col("label").isNotNull())
    test, train = rows.where(split_of() == "c"), rows.where(split_of() == "a")
    table = prompts.prompt_sweep(test, train, ["summary_statistical", "summary_trend"], "label", RuleClient)
    return rounded(table, ["log_loss", "auroc", "average_precision"])


@query(
    "settings_grid",
    """select conv_id, turn, text, shots, mode from (select conv_id, turn from conversations)
    cross join (values ('statistical'), ('trend')) a(text) cross join (values ('few-shot'), ('zero-shot')) b(shots)
    cross join (values ('binary'), ('score')) c(mode)""",
)
def _(t):
    settings = {"text": ["statistical", "trend"], "shots": ["few-shot", "zero-shot"], "mode": ["binary", "score"]}
    return expand_settings(t.conversations.select("conv_id", "turn"), settings)


# ---- embeddings -------------------------------------------------------------------------------------------------------


@query(
    "embed_text",
    f"""with words as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) as word from documents),
    slots as (select doc_id, ('0x' || md5(word)[1:8])::bigint % 32 as slot, count(*)::float as k from words group by 1, 2),
    lengths as (select doc_id, sqrt(sum(k::double * k))::float as norm from slots group by 1),
    entries as (select doc_id, map_from_entries(list((slot, {round_sql("(k / norm)::double", 5)}))) as by_slot from slots join lengths using (doc_id) group by 1)
    select doc_id, [coalesce(by_slot[s], 0.0::double) for s in range(32)] as embedding from documents left join entries using (doc_id)""",
)
def _(t):
    made = vectors.embed_text(t.documents, "text", HashingEmbedder, ["doc_id"])
    return made.select("doc_id", F.transform("embedding", lambda v: half_up(v.cast("double"), 5)).alias("embedding"))


TOKENS_SQL = f"""{PANEL_SQL}, readings as (
  select entity_id, ts, variable, value as v from (select entity_id, ts, {cols_sql("{c}")} from panel)
    unpivot (value for variable in ({", ".join(VARIABLES)})) where value is not null),
tokens as (
  select entity_id, variable, ts, [v::float, (v - coalesce(lag(v) over w, v))::float, (sum(v) over r / count(v) over r)::float,
    (max(v) over r)::float, (min(v) over r)::float] as token
  from readings window w as (partition by entity_id, variable order by ts),
    r as (partition by entity_id, variable order by ts rows between unbounded preceding and current row))"""


@query(
    "embed_series",
    f"""with {TOKENS_SQL} select entity_id, variable, 0::bigint as piece,
      list([{round_sql("x::double", 3)} for x in token] order by ts) as tokens from tokens group by entity_id, variable""",
)
def _(t):
    made = vectors.embed_series(hourly_panel(t), VARIABLES, StatisticsEmbedder, chunk_hours=None)
    rounded_tokens = F.transform("tokens", lambda token: F.transform(token, lambda v: half_up(v.cast("double"), 3)))
    return made.select("entity_id", "variable", "piece", rounded_tokens.alias("tokens"))


@query(
    "patient_embedding",
    f"""with {TOKENS_SQL}, {OUTCOMES_SQL}, parts as (select entity_id, variable, unnest(token)::double as x, generate_subscripts(token, 1) as i from tokens),
    means as (select entity_id, variable, i, avg(x) as x from parts group by all),
    pooled as (select entity_id, i, avg(x) as x from means group by all)
    select entity_id, list({round_sql("x")} order by i) as embedding, any_value(label) as label
    from pooled join outcomes using (entity_id) group by entity_id""",
)
def _(t):
    pooled = vectors.patient_embedding(hourly_panel(t), VARIABLES, StatisticsEmbedder, chunk_hours=None)
    labelled = vectors.labelled_embeddings(pooled, outcomes(t))
    return labelled.select("entity_id", F.transform("embedding", lambda v: half_up(v)).alias("embedding"), "label")


@query(
    "mean_pool",
    f"""with parts as (select label, generate_subscripts(embedding, 1) as pos, unnest(embedding)::double as v from embeddings),
    means as (select label, pos, avg(v) as v from parts group by all)
    select label, list({round_sql("v")} order by pos) as embedding from means group by label""",
)
def _(t):
    pooled = vectors.mean_pool(t.embeddings, ["label"])
    return pooled.select("label", F.transform("embedding", lambda v: half_up(v)).alias("embedding"))


CHANNELS = ["v0", "v1", "v2"]


@query(
    "concat_channels",
    f"""with c as (select vec_id // 4 as entity_id, 'v' || (vec_id % 4) as variable, embedding from embeddings),
    w as (select entity_id, {cols_sql("any_value(embedding) filter (where variable = '{c}') as {c}", CHANNELS)} from c group by 1)
    select entity_id, list_concat({", ".join(f"coalesce({c}, list_transform(range(64), lambda i: 0::float))" for c in CHANNELS)}) as embedding
    from w""",
)
def _(t):
    parts = t.embeddings.select(
        F.floor(F.col("vec_id") / 4).alias("entity_id"),
        F.concat(F.lit("v"), (F.col("vec_id") % 4).cast("string")).alias("variable"),
        "embedding",
    )
    return vectors.concat_channels(parts, CHANNELS, 64)


@query(
    "labelled_embeddings",
    "select vec_id as entity_id, embedding, quality as label from embeddings join labels on vec_id = doc_id",
)
def _(t):
    rows = t.embeddings.select(F.col("vec_id").alias("entity_id"), "embedding")
    return vectors.labelled_embeddings(rows, outcomes(t))


@query(
    "embeddings_to_wide",
    "select vec_id, label, " + ", ".join(f'embedding[{i + 1}] as "{i}"' for i in range(64)) + " from embeddings",
)
def _(t):
    return vectors.embeddings_to_wide(t.embeddings, 64, ["vec_id", "label"])


@query("embeddings_from_wide", "select vec_id, label, embedding from embeddings")
def _(t):
    wide = vectors.embeddings_to_wide(t.embeddings, 64, ["vec_id", "label"])
    return vectors.embeddings_from_wide(wide, ["vec_id", "label"])


# ---- files ------------------------------------------------------------------------------------------------------------


@query(
    "extract_entity_id",
    f"with {OBS_SQL} select event_id, entity_id * 10 as entity_id, variable as Parameter, value as Value from obs",
)
def _(t):
    file = F.concat(F.lit("f"), F.col("entity_id").cast("string"))
    rows = observations(t).select(file.alias("file"), "event_id", F.col("variable").alias("Parameter"), F.col("value").alias("Value"))
    ids = observations(t).select("entity_id").distinct().select(
        file.alias("file"),
        F.lit(None).cast("bigint").alias("event_id"),
        F.lit("RecordID").alias("Parameter"),
        (F.col("entity_id") * 10).cast("double").alias("Value"),
    )
    return extract_entity_id(rows.unionByName(ids))


INGEST_SQL = PANEL_SQL.replace("user_id as entity_id, ts, event_type", "user_id as entity_id, date_trunc('minute', ts) as ts, event_type")


@query("ingest_files", f"with {INGEST_SQL} select entity_id, ts, {cols_sql(round_sql('{c}') + ' as {c}')} from panel")
def _(t):
    """Events as files of elapsed time, parameter and value, one per entity, and back to the hourly panel."""
    root = scratch_path(t.spark, "observations")
    minutes = F.expr(f"timestampdiff(minute, timestamp_ntz '{BASE_TIME}', ts)")
    clock = F.concat_ws(":", F.lpad((minutes / 60).cast("int").cast("string"), 3, "0"), F.lpad((minutes % 60).cast("string"), 2, "0"))
    rows = observations(t).where("value is not null").select(
        "entity_id", "event_id", clock.alias("Time"), F.col("variable").alias("Parameter"), F.col("value").alias("Value")
    )
    ids = rows.select("entity_id").distinct().select(
        "entity_id",
        F.lit(None).cast("bigint").alias("event_id"),
        F.lit("00:00").alias("Time"),
        F.lit("RecordID").alias("Parameter"),
        F.col("entity_id").cast("double").alias("Value"),
    )
    files = rows.unionByName(ids).repartition("entity_id").sortWithinPartitions("entity_id", "event_id").drop("event_id")
    files.write.partitionBy("entity_id").csv(root, header=True)
    return rounded(ingest_panel(t.spark, f"{root}/*/*.csv", VARIABLES, BASE_TIME), VARIABLES)


@query(
    "all_stages",
    f"""with {PANEL_SQL} select stage, {SPLIT_SQL} as split, count(*) as n, count(click) as clicks
    from panel, (values {", ".join(f"('{s}')" for s in stages.STAGES)}) as s(stage) group by all""",
)
def _(t):
    """The panel written as every stage and read back by that stage's own loader."""
    root = scratch_path(t.spark, "stages")
    panel = hourly_panel(t).select("entity_id", "ts", "click", split_of())
    found = None
    for stage in stages.STAGES:
        stages.write_stage(panel, root, stage)
        loaded = getattr(stages, f"load_{stage}")(t.spark, root).select(F.lit(stage).alias("stage"), "split", "click")
        found = loaded if found is None else found.unionByName(loaded)
    return found.groupBy("stage", "split").agg(F.count("*").alias("n"), F.count("click").alias("clicks"))


@query(
    "stage_round_trip",
    f"""with {PANEL_SQL} select entity_id, ts, {round_sql("click")} as click, {SPLIT_SQL} as split from panel
    where {SPLIT_SQL} = 'b'""",
)
def _(t):
    root = scratch_path(t.spark, "stages")
    stages.write_stage(hourly_panel(t).select("entity_id", "ts", "click", split_of()), root, "initial")
    return rounded(stages.load_stage(t.spark, root, "initial", "b"), ["click"])


@query(
    "final_stage",
    f"""with {PANEL_SQL} select entity_id, ts, {round_sql("view")} as view, {SPLIT_SQL} as split from panel""",
)
def _(t):
    root = scratch_path(t.spark, "stages")
    panel = hourly_panel(t).select("entity_id", "ts", "view", F.lit(1).alias("ICUType"), split_of())
    stages.write_stage(panel, root, "final")
    return rounded(stages.load_final(t.spark, root), ["view"])


@query("outcomes_csv", "select doc_id as entity_id, quality as label from labels")
def _(t):
    path = scratch_path(t.spark, "outcomes")
    t.labels.write.csv(path, header=True)
    return tables.load_outcomes(t.spark, path, "doc_id bigint, quality int, toxic int", "doc_id", "quality")


@query("text_csv", "select conv_id, turn, role, text from conversations")
def _(t):
    path = scratch_path(t.spark, "texts")
    tables.write_text_csv(t.conversations.select("conv_id", "turn", "role", "text"), path)
    return tables.read_text_csv(t.spark, path, "conv_id bigint, turn bigint, role string, text string")


@query("embeddings_csv", "select vec_id, label, embedding from embeddings")
def _(t):
    path = scratch_path(t.spark, "vectors")
    tables.write_embeddings_csv(t.embeddings, path, 64, ["vec_id", "label"])
    return tables.read_embeddings_csv(t.spark, path, 64, {"vec_id": "bigint", "label": "int"})
