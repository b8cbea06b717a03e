"""Named queries over the test tables, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import functions as fn
from . import operators as op
from .plans.generate import GenerateConfig, generate, prepare, records, statuses, written_ids
from .session import file_bytes, shared_root, small_batches
from .sources import prefetch_datasets, read_jsonl, read_ordered, read_remote, write_jsonl, write_ordered
from .sources.hadoop import Store

Query = Callable[[SparkSession, str], DataFrame]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
MODEL = "Qwen/Qwen3-32B"
DATASET, SPLIT = "documents", "train"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _extracted(df: DataFrame, *keep: str) -> DataFrame:
    return op.with_source_text(df).select(*keep, "source_fields", "source_text")


def dataset_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name in TABLES:
        one = op.dataset_profile(table(spark, sf_dir, name), name)
        out = one if out is None else out.unionByName(one)
    return out


def row_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.with_row_index(table(spark, sf_dir, "documents")).select("row_index", "doc_id")


def row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rows_in_range(table(spark, sf_dir, "documents"), 100, 50).select("row_index", "doc_id", "text")


def row_range_negative_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rows_in_range(table(spark, sf_dir, "documents"), -5, 10).select("row_index", "doc_id")


def row_range_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rows_in_range(table(spark, sf_dir, "conversations"), 20).select("row_index", "conv_id", "turn")


#: Of a table's files, the bytes that go to one file of a copy, about.
FILE_BYTES = 32 << 20


def _parts(df: DataFrame, least: int = 5) -> int:
    """Into how many parts rows of files are dealt: more with larger files, so that a part, which one task takes, stays small."""
    return max(least, -(-file_bytes(df) // FILE_BYTES))


def _files(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """The documents in five files, or more if they are large, of another format, in the order of doc_id."""
    path, docs = _folder(spark, f"rows-{kind}"), table(spark, sf_dir, "documents").select("doc_id", "text")
    docs.repartitionByRange(_parts(docs), "doc_id").sortWithinPartitions("doc_id").write.format(kind).save(path)
    return spark.read.schema(docs.schema).format(kind).load(path)


def row_ordinal_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.with_row_index(_files(spark, sf_dir, "json")).select("row_index", "doc_id")


def row_range_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rows_in_range(_files(spark, sf_dir, "json"), 30, 111).select("row_index", "doc_id", "text")


def row_ordinal_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.with_row_index(_files(spark, sf_dir, "parquet")).select("row_index", "doc_id")


def row_range_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rows_in_range(_files(spark, sf_dir, "parquet"), 30, 111).select("row_index", "doc_id", "text")


def collapse_whitespace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(spark, sf_dir).select("doc_id", fn.collapse_ws(F.col("text")).alias("collapsed"))


def truncate_ellipsis_200(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(spark, sf_dir).select("doc_id", fn.truncate_ellipsis(fn.collapse_ws(F.col("text")), 200).alias("cut"))


def truncate_small_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(spark, sf_dir).select("doc_id", fn.truncate_ellipsis(fn.collapse_ws(F.col("text")), 2).alias("cut"))


def nonblank_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = F.when(F.col("doc_id") % 4 == 0, F.lit(" \t\u00a0\u3000\n")).when(F.col("doc_id") % 4 == 1, F.lit(None)).otherwise(F.col("text"))
    return _text(spark, sf_dir).select("doc_id", fn.is_nonblank(made).alias("nonblank"))


def preferred_text_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(table(spark, sf_dir, "documents"), "doc_id")


def preferred_over_metadata_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(table(spark, sf_dir, "conversations"), "conv_id", "turn")


def fallback_text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(table(spark, sf_dir, "pages"), "page_id")


def fallback_text_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(table(spark, sf_dir, "part"), "p_partkey")


def fallback_with_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    k = F.col("p_partkey") % 4
    part = part.withColumn("p_name", F.when(k == 1, F.lit(None)).otherwise(F.col("p_name")))
    part = part.withColumn("p_brand", F.when(k.isin(1, 2), F.lit(" \t ")).otherwise(F.col("p_brand")))
    part = part.withColumn("p_type", F.when(k == 1, F.lit("")).otherwise(F.concat(F.lit("\n "), "p_type")))
    return _extracted(part, "p_partkey")


def preferred_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _text(spark, sf_dir)
    k = F.col("doc_id") % 3
    d = d.select("doc_id", F.concat(F.lit("body "), "text").alias("body"), F.when(k == 0, F.lit(None)).otherwise(F.concat(F.lit("content "), "text")).alias("content"), F.when(k == 2, F.col("text")).otherwise(F.lit("  ")).alias("text"))
    return _extracted(d, "doc_id")


def skip_no_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name in ("embeddings", "labels"):
        found = op.with_source_text(table(spark, sf_dir, name)).agg(F.count_if(F.col("source_text").isNull()).alias("skipped"), F.count("*").alias("rows"))
        found = found.select(F.lit(name).alias("dataset"), "skipped", "rows")
        out = found if out is None else out.unionByName(found)
    return out


def infer_row_id_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op.with_row_id(op.with_row_index(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", F.col("row_id_text").alias("row_id"))


def infer_row_id_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op.with_row_id(op.with_row_index(table(spark, sf_dir, "pages")))
    return rows.select("page_id", F.col("row_id_text").alias("row_id"))


def row_ordinal_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a frame that is no scan of files: customers by balance, then key."""
    some = table(spark, sf_dir, "customer").select("c_acctbal", "c_custkey").repartition(5)
    return op.with_row_index(some, ["c_acctbal", "c_custkey"])


def infer_row_id_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are doubles, of all sizes, as Python writes them."""
    k = F.col("c_custkey") % 5
    size = F.when(k == 0, F.col("c_acctbal")).when(k == 1, F.col("c_acctbal") * F.lit(1e18)).when(k == 2, F.col("c_acctbal") / F.lit(3e9)).when(k == 3, F.col("c_custkey") * F.lit(1e14)).otherwise(F.col("c_custkey") / F.lit(7.0))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_index"), size.alias("id"))
    return op.with_row_id(rows).select(F.col("row_index").alias("c_custkey"), F.col("row_id_text").alias("row_id"))


def user_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", op.user_prompt(F.col("source_text")).alias("prompt"))


def chat_request_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = user_prompt(spark, sf_dir)
    return found.select("doc_id", op.chat_request_json(F.col("prompt"), MODEL).alias("request"), op.chat_request_json(F.col("prompt"), MODEL, enable_thinking=True).alias("thinking_request"))


def _replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply for each document, of one of eight shapes on which JSON decoders agree."""
    small_batches(spark)
    q = fn.json_quote(fn.collapse_ws(F.col("text")))
    good = F.concat(F.lit('{"question": "  q '), F.col("doc_id"), F.lit('  ", "answer": '), q, F.lit("}"))
    shapes = [
        good,
        F.concat(F.lit("<think>{ not this }</think>\n"), good),
        F.concat(F.lit("<THINK>\nlines\n</Think> "), good),
        F.concat(F.lit("```json\n"), good, F.lit("\n```")),
        F.concat(F.lit("no object: "), F.regexp_replace("text", r"[{}]", "")),
        F.lit('{"question": 5, "answer": "a"}'),
        F.lit('{"question": "q", "answer": "   "}'),
        F.lit('{"QUESTION": "q", "answer": "a"}'),
    ]
    shape = shapes[-1]
    for k in range(6, -1, -1):
        shape = F.when(F.col("doc_id") % 8 == k, shapes[k]).otherwise(shape)
    return _text(spark, sf_dir).select("doc_id", shape.alias("reply"))


def strip_reasoning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("doc_id", fn.strip_reasoning(F.col("reply")).alias("stripped"))


def json_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("doc_id", fn.json_span(fn.strip_reasoning(F.col("reply"))).alias("span"))


def parse_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replies(spark, sf_dir).select("doc_id", fn.reply_struct(F.col("reply")).alias("r")).select("doc_id", "r.question", "r.answer", "r.error")


def assistant_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _text(spark, sf_dir)
    return d.select("doc_id", op.assistant_json(F.concat(F.lit('What is "'), F.col("doc_id"), F.lit('\\"?')), F.col("text")).alias("assistant"))


def _written(spark: SparkSession, sf_dir: str, name: str = DATASET) -> DataFrame:
    """Prepared rows with the echo backend's replies, as columns."""
    prepared = prepare(table(spark, sf_dir, name))
    stem, text = F.lit(op.EchoBackend.stem), F.col("source_text")
    none = F.lit(None).cast("string")
    usable = text.isNotNull()
    return prepared.select(
        "*",
        F.when(usable, fn.strip_ws(F.concat(stem, F.substring(text, 1, 40)))).otherwise(none).alias("question"),
        F.when(usable, fn.strip_ws(F.substring(text, 1, 80))).otherwise(none).alias("answer"),
        F.when(usable, F.lit("written")).otherwise(F.lit("skipped_no_text")).alias("status"),
    )


def generate_offline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: documents to chat records, without a Python worker."""
    return records(_written(spark, sf_dir), DATASET, SPLIT).select("row_index", "line")


def chat_record_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records(_written(spark, sf_dir), DATASET, SPLIT)
    said, meta = F.col("record.messages"), F.col("record.meta")
    return found.select("row_index", F.size(said).alias("messages"), said[0]["role"].alias("role0"), said[0]["content"].alias("content0"), said[1]["role"].alias("role1"), said[1]["content"].alias("content1"), meta["dataset"].alias("dataset"), meta["split"].alias("split"), meta["row_id"].alias("row_id"), meta["source_fields"].alias("source_fields"))


def generate_backend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As generate_offline, through infer() and its Python workers."""
    return records(statuses(prepare(table(spark, sf_dir, DATASET)), op.EchoBackend(), 8), DATASET, SPLIT).select("row_index", "line")


def _mixed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    error = fn.reply_struct(F.col("reply"))["error"]
    return _replies(spark, sf_dir).select("doc_id", F.when(error.isNull(), F.lit("written")).otherwise(F.lit("skipped_inference")).alias("status")).unionByName(
        op.with_source_text(table(spark, sf_dir, "labels")).where("source_text is null").select("doc_id", F.lit("skipped_no_text").alias("status"))
    )


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.run_summary(_mixed_statuses(spark, sf_dir))


def status_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.status_breakdown(_mixed_statuses(spark, sf_dir))


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder where all executors can write."""
    import uuid

    return f"{shared_root(spark)}/quern/{name}-{uuid.uuid4().hex[:12]}"


def resume_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over two row ranges, appended to one folder of JSON Lines, read back."""
    out, rows = _folder(spark, "resume"), _written(spark, sf_dir)
    for start, most in ((0, 150), (150, None)):
        write_jsonl(records(op.select_rows(rows, start, most), DATASET, SPLIT), out)
    return read_jsonl(spark, out)


def records_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written in the order of rows, side by side, and read back with their positions."""
    folder = _folder(spark, "ordered")
    lines = records(_written(spark, sf_dir), DATASET, SPLIT)
    write_ordered(lines, folder, "row_index", parts=_parts(lines))
    return read_ordered(spark, folder)


def resume_skips_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left to ask about after a run over a row range, by the index that the run wrote."""
    out = _folder(spark, "index") + "/out"
    generate(spark, GenerateConfig(DATASET, out, root=sf_dir, backend="echo", start_row=30, max_rows=150))
    return prepare(table(spark, sf_dir, DATASET), known=written_ids(spark, out, DATASET, SPLIT)).select("row_index", "row_id", "source_text")


def stream_row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream of files, two to a batch: rows 100 to 249 of it, by ordinals that go on from batch to batch."""
    from .streaming import generate_stream

    docs, path, store = table(spark, sf_dir, "documents").select("doc_id", "text").where("doc_id >= 0"), _folder(spark, "stream"), Store(spark)
    docs.repartitionByRange(_parts(docs), "doc_id").sortWithinPartitions("doc_id").select("text").write.parquet(f"{path}/in")
    # Written side by side; a stream's files are in the order of their times.
    store.in_turn([file for file, _, _ in store.files(f"{path}/in") if file.rpartition("/")[2].startswith("part-")])
    rows = spark.readStream.schema("text string").option("maxFilesPerTrigger", 2).parquet(f"{path}/in")
    generate_stream(rows, op.EchoBackend(), f"{path}/out", f"{path}/mark", DATASET, start_row=100, max_rows=150).awaitTermination()
    return spark.read.text(f"{path}/out").select(F.col("value").alias("line"))


def remote_row_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row range and a column list through the data source, which reads their bytes alone."""
    return read_remote(spark, f"{sf_dir}/documents.parquet", ["row_index", "doc_id", "text"]).where("row_index >= 100 and row_index < 150")


def prefetch_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second fetch of what is cached: nothing is written again."""
    cache = _folder(spark, "cache")
    prefetch_datasets(spark, ["region", "documents"], cache, root=sf_dir)
    found = prefetch_datasets(spark, ["region", "documents", "nation"], cache, root=sf_dir)
    return found.select("dataset", "status", "rows")


def prefetch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables cached as datasets, and one that isn't there."""
    found = prefetch_datasets(spark, ["region", "nation", "benchmark", "absent"], _folder(spark, "cache"), root=sf_dir)
    return found.select("dataset", "split", "status", F.coalesce("rows", F.lit(0)).alias("rows"), F.array_join("columns", ",").alias("columns"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        dataset_profile, row_ordinal, row_ordinal_json, row_ordinal_many_files, row_range, row_range_json, row_range_many_files, row_range_negative_start, row_range_open, collapse_whitespace, truncate_ellipsis_200, truncate_small_limit, nonblank_test,
        preferred_text_documents, preferred_over_metadata_conversations, fallback_text_pages, fallback_text_part, fallback_with_blanks, preferred_priority, skip_no_text,
        infer_row_id_key, infer_row_id_ordinal, infer_row_id_float, row_ordinal_sorted, user_prompt, chat_request_json, strip_reasoning, json_span, parse_qa, assistant_json, chat_record_typed, generate_offline,
        generate_backend, run_summary, status_breakdown, resume_append, records_in_order, resume_skips_written, stream_row_range, remote_row_range, prefetch_again, prefetch_report,
    )
}


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _e(text: str) -> str:
    """A SQL string with line ends, quotes and so on escaped."""
    return "e'" + text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\t", "\\t") + "'"


_WS = r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_WS}', ' ', 'g'), ' ')"


def _cut(c: str, most: int = op.extract.SOURCE_CHARS) -> str:
    return f"case when length({c}) <= {most} then {c} else rtrim(left({c}, {most - 3}), ' ') || '...' end"


def _source(c: str, most: int = op.extract.SOURCE_CHARS) -> str:
    return _cut(_collapse(c), most)


def _prompt(c: str) -> str:
    return f"{_e(op.prompts.PROMPT_BEFORE)} || {c} || {_e(op.prompts.PROMPT_AFTER)}"


def _json(c: str) -> str:
    return f"cast(to_json({c}) as varchar)"


def _pair(q: str, a: str) -> str:
    return f"""'{{"question": ' || {_json(q)} || ', "answer": ' || {_json(a)} || '}}'"""


_STRIP = f"regexp_replace(%s, '^{_WS}|{_WS}$', '', 'g')"


def _reply_sql() -> str:
    good = f"""'{{"question": "  q ' || doc_id || '  ", "answer": ' || {_json(_collapse("text"))} || '}}'"""
    return f"""(select doc_id, case doc_id % 8
      when 0 then {good} when 1 then {_e("<think>{ not this }</think>" + chr(10))} || {good} when 2 then {_e("<THINK>" + chr(10) + "lines" + chr(10) + "</Think> ")} || {good}
      when 3 then {_e("```json" + chr(10))} || {good} || {_e(chr(10) + "```")} when 4 then 'no object: ' || regexp_replace(text, '[{{}}]', '', 'g')
      when 5 then '{{"question": 5, "answer": "a"}}' when 6 then '{{"question": "q", "answer": "   "}}' else '{{"QUESTION": "q", "answer": "a"}}' end as reply from documents)"""


_STRIPPED = _STRIP % "regexp_replace(reply, '(?is)<think>.*?</think>', '', 'g')"
_SPAN = f"nullif(regexp_extract({_STRIPPED}, '(?s)\\{{.*\\}}', 0), '')"
_RECORDED = f"""(select row_index, doc_id, prompt, source_text,
    {_pair(_STRIP % f"({_sql(op.EchoBackend.stem)} || left(source_text, 40))", _STRIP % "left(source_text, 80)")} as said from
    (select *, {_prompt("source_text")} as prompt from (select doc_id as row_index, doc_id, {_source("text")} as source_text from documents)))"""
_LINE = f"""'{{"messages": [{{"role": "user", "content": ' || {_json("prompt")} || '}}, {{"role": "assistant", "content": ' || {_json("said")} || '}}], "meta": {{"dataset": "{DATASET}", "split": "{SPLIT}", "row_id": "' || doc_id || '", "source_fields": "text"}}}}'"""


def _request(thinking: bool) -> str:
    end = '], "temperature": 0.2, "max_tokens": 512' + ("" if thinking else ', "chat_template_kwargs": {"enable_thinking": false}') + "}"
    start = '{"model": "' + MODEL + '", "messages": [{"role": "system", "content": "' + op.SYSTEM_PROMPT + '"}, {"role": "user", "content": '
    return f"{_sql(start)} || {_json(_prompt(_source('text')))} || {_sql('}' + end)}"


_STATUS = f"""(select case doc_id % 8 when 4 then 'skipped_inference' when 5 then 'skipped_inference' when 6 then 'skipped_inference' when 7 then 'skipped_inference' else 'written' end as status from documents
  union all select 'skipped_no_text' from labels)"""

_PROFILE_COLUMNS = {
    "region": "r_regionkey,r_name",
    "nation": "n_nationkey,n_name,n_regionkey",
    "customer": "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment",
    "supplier": "s_suppkey,s_name,s_nationkey,s_acctbal",
    "part": "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice",
    "orders": "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority",
    "lineitem": "l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate",
    "events": "event_id,ts,user_id,event_type,value,props",
    "documents": "doc_id,text,lang,source,n_chars",
    "embeddings": "vec_id,embedding,label",
    "pages": "page_id,url,html",
    "benchmark": "item_id,text",
    "labels": "doc_id,quality,toxic",
    "conversations": "conv_id,turn,role,text",
}

ORACLE_SQL: dict[str, str] = {
    "dataset_profile": " union all ".join(f"select '{t}' as dataset, count(*) as rows, '{_PROFILE_COLUMNS[t]}' as columns from {t}" for t in TABLES),
    "row_ordinal": "select doc_id as row_index, doc_id from documents",
    "row_ordinal_json": "select doc_id as row_index, doc_id from documents",
    "row_ordinal_many_files": "select doc_id as row_index, doc_id from documents",
    "row_range_json": "select doc_id as row_index, doc_id, text from documents where doc_id >= 30 and doc_id < 141",
    "row_range_many_files": "select doc_id as row_index, doc_id, text from documents where doc_id >= 30 and doc_id < 141",
    "row_range": "select doc_id as row_index, doc_id, text from documents where doc_id >= 100 and doc_id < 150",
    "row_range_negative_start": "select doc_id as row_index, doc_id from documents where doc_id < 5",
    "row_range_open": "select * from (select row_number() over (order by conv_id, turn) - 1 as row_index, conv_id, turn from conversations) where row_index >= 20",
    "collapse_whitespace": f"select doc_id, {_collapse('text')} as collapsed from documents",
    "truncate_ellipsis_200": f"select doc_id, {_source('text', 200)} as cut from documents",
    "truncate_small_limit": f"select doc_id, case when length(c) <= 2 then c else rtrim(left(c, -1), ' ') || '...' end as cut from (select doc_id, {_collapse('text')} as c from documents)",
    "nonblank_test": "select doc_id, doc_id % 4 >= 2 as nonblank from documents",
    "preferred_text_documents": f"select doc_id, 'text' as source_fields, {_source('text')} as source_text from documents",
    "preferred_over_metadata_conversations": f"select conv_id, turn, 'text' as source_fields, {_source('text')} as source_text from conversations",
    "fallback_text_pages": f"select page_id, 'html' as source_fields, {_source('html')} as source_text from pages",
    "fallback_text_part": f"""select p_partkey, 'p_name,p_brand,p_type' as source_fields, {_source("p_name || ' ' || p_brand || ' ' || p_type")} as source_text from part""",
    "fallback_with_blanks": f"""select p_partkey, case p_partkey % 4 when 1 then null when 2 then 'p_name,p_type' else 'p_name,p_brand,p_type' end as source_fields,
        case p_partkey % 4 when 1 then null when 2 then {_source("p_name || ' ' || p_type")} else {_source("p_name || ' ' || p_brand || ' ' || p_type")} end as source_text from part""",
    "preferred_priority": f"""select doc_id, case doc_id % 3 when 2 then 'text' when 1 then 'content' else 'body' end as source_fields,
        {_source("case doc_id % 3 when 2 then text when 1 then 'content ' || text else 'body ' || text end")} as source_text from documents""",
    "skip_no_text": "select 'embeddings' as dataset, count(*) as skipped, count(*) as rows from embeddings union all select 'labels', count(*), count(*) from labels",
    "infer_row_id_key": "select doc_id, cast(doc_id as varchar) as row_id from documents",
    "infer_row_id_ordinal": "select page_id, cast(page_id as varchar) as row_id from pages",
    "row_ordinal_sorted": "select row_number() over (order by c_acctbal, c_custkey) - 1 as row_index, c_acctbal, c_custkey from customer",
    "infer_row_id_float": """select c_custkey, cast(case c_custkey % 5 when 0 then c_acctbal when 1 then c_acctbal * cast(1e18 as double) when 2 then c_acctbal / cast(3e9 as double)
        when 3 then c_custkey * cast(1e14 as double) else c_custkey / cast(7 as double) end as varchar) as row_id from customer""",
    "user_prompt": f"select doc_id, {_prompt(_source('text'))} as prompt from documents",
    "chat_request_json": f"select doc_id, {_request(False)} as request, {_request(True)} as thinking_request from documents",
    "strip_reasoning": f"select doc_id, {_STRIPPED} as stripped from {_reply_sql()}",
    "json_span": f"select doc_id, {_SPAN} as span from {_reply_sql()}",
    "parse_qa": f"""select doc_id, case when doc_id % 8 < 4 then 'q ' || doc_id end as question, case when doc_id % 8 < 4 then {_collapse("text")} end as answer,
        case doc_id % 8 when 4 then 'no_json' when 5 then 'no_question' when 6 then 'no_answer' when 7 then 'no_question' end as error from documents""",
    "assistant_json": f"""select doc_id, {_pair("'What is \"' || doc_id || '" + chr(92) + "\"?'", "text")} as assistant from documents""",
    "chat_record_typed": f"select row_index, 2 as messages, 'user' as role0, prompt as content0, 'assistant' as role1, said as content1, '{DATASET}' as dataset, '{SPLIT}' as split, cast(doc_id as varchar) as row_id, 'text' as source_fields from {_RECORDED}",
    "generate_offline": f"select row_index, {_LINE} as line from {_RECORDED}",
    "generate_backend": f"select row_index, {_LINE} as line from {_RECORDED}",
    "run_summary": f"select count(*) filter (status = 'written') as written, count(*) filter (status != 'written') as skipped from {_STATUS}",
    "status_breakdown": f"select status, count(*) as rows from {_STATUS} group by status",
    "resume_append": f"select {_LINE} as line from {_RECORDED}",
    "records_in_order": f"select row_index as position, {_LINE} as line from {_RECORDED}",
    "resume_skips_written": f"select doc_id as row_index, cast(doc_id as varchar) as row_id, {_source('text')} as source_text from documents where doc_id < 30 or doc_id >= 180",
    "stream_row_range": f"select {_LINE} as line from {_RECORDED} where row_index >= 100 and row_index < 250",
    "remote_row_range": "select doc_id as row_index, doc_id, text from documents where doc_id >= 100 and doc_id < 150",
    "prefetch_again": "select 'region' as dataset, 'unchanged' as status, count(*) as rows from region union all select 'documents', 'unchanged', count(*) from documents union all select 'nation', 'cached', count(*) from nation",
    "prefetch_report": " union all ".join([*(f"select '{t}' as dataset, 'train' as split, 'cached' as status, count(*) as rows, '{_PROFILE_COLUMNS[t]}' as columns from {t}" for t in ("region", "nation", "benchmark")), "select 'absent', 'train', 'no_data_files', 0, null"]),
}
