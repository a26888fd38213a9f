"""Registered queries of the library's operators over the test tables, and their DuckDB oracles."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .endpoints import Debug, Fasta, Jdbc, KeyValue, Lines, TokenFile, TokenUnit, Xml
from .functions import bpe, json, primes, softlabel, text
from .operators import bag, ids, keyed
from .operators.pipeline import REFUSED, run, sink, source
from .plans import protein
from .plans import text as texts
from .sinks.files import write_fasta, write_histogram, write_lines, write_xml
from .sinks.jdbc import write_jdbc
from .sources.fasta import read_fasta, read_fastq
from .sources.jdbc import read_jdbc
from .sources.lines import read_lines
from .sources.tokenfile import read_tokens, write_tokens
from .sources.xml import read_xml
from .storage import fresh_path, spread, table
from .streaming.pipeline import windowed_counts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its name, with its oracle."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# Bytes and text


@query("""
with b as (select unnest(regexp_extract_all(hex(encode(text || chr(3))), '..')) h from documents),
n as (select ('0x' || h)::INT byte, count(*) c from b group by 1)
select r.i::INT as byte, coalesce(n.c, 0)::BIGINT as count from range(256) r(i) left join n on n.byte = r.i
""")
def byte_freq(spark: SparkSession, d: str) -> DataFrame:
    return bag.byte_histogram(spark, table(spark, d, "documents"))


@query("""
with b as (select unnest(regexp_extract_all(hex(encode(text || chr(3))), '..')) h from conversations),
n as (select ('0x' || h)::INT byte, count(*) c from b group by 1)
select r.i::INT as byte, coalesce(n.c, 0)::BIGINT as count from range(256) r(i) left join n on n.byte = r.i
""")
def histogram_csv(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "histogram")
    write_histogram(bag.byte_histogram(spark, table(spark, d, "conversations")), path)
    return spark.read.schema("byte int, count long").csv(path)


@query("select doc_id, (strlen(text) + 1)::BIGINT as num_tokens, hex(encode(text || chr(3))) as tokens_hex from documents")
def byte_tokenize(spark: SparkSession, d: str) -> DataFrame:
    ended = text.utf8(text.with_end(F.col("text")))
    return table(spark, d, "documents").select("doc_id", F.octet_length(ended).cast("long").alias("num_tokens"), F.hex(ended).alias("tokens_hex"))


@query("select p_partkey, length(p_name)::BIGINT as n_chars, p_name[1] as first_char from part")
def text_characters(spark: SparkSession, d: str) -> DataFrame:
    chars = text.characters(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", F.size(chars).cast("long").alias("n_chars"), F.get(chars, 0).alias("first_char"))


@query("select c_custkey, trim(c_name) as trimmed, split_part(c_name, ' ', 1) as id, nullif(trim(c_mktsegment), '') as description from customer")
def text_headers(spark: SparkSession, d: str) -> DataFrame:
    padded = F.concat(F.lit(" \t"), F.col("c_name"), F.lit("  "))
    header = F.concat(F.split_part("c_name", F.lit(" "), F.lit(1)), F.lit("\t"), F.col("c_mktsegment"), F.lit("  "))
    return table(spark, d, "customer").select(
        "c_custkey", text.trim(padded).alias("trimmed"), text.header_id(header).alias("id"), text.header_description(header).alias("description")
    )


@query("""
select s_suppkey, s_name || ' -> ' || s_nationkey::VARCHAR as pair,
  '>' || s_suppkey::VARCHAR || ' ' || s_name || '\\n' || strlen(s_name)::VARCHAR as fasta, 'MmapItem(units_count: ' || length(s_name)::VARCHAR || ')' as tokens
from supplier
""")
def text_displays(spark: SparkSession, d: str) -> DataFrame:
    id_ = F.col("s_suppkey").cast("string")
    return table(spark, d, "supplier").select(
        "s_suppkey",
        text.display_pair(F.col("s_name"), F.col("s_nationkey").cast("string")).alias("pair"),
        text.display_fasta(id_, F.col("s_name"), F.col("s_name")).alias("fasta"),
        text.display_tokens(text.characters(F.col("s_name"))).alias("tokens"),
    )


# Sources and sinks, there and back


@query("select c_custkey, c_name || chr(9) || c_mktsegment as content from customer")
def lines_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    write_lines(table(spark, d, "customer"), F.concat_ws("\t", "c_name", "c_mktsegment", "c_custkey"), path)
    back = read_lines(spark, path)
    parts = F.split("content", "\t")
    return back.select(parts[2].cast("long").alias("c_custkey"), F.concat_ws("\t", parts[0], parts[1]).alias("content"))


@query("select p_name as content from part order by p_partkey limit 100")
def lines_first_n(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "lines")
    write_lines(table(spark, d, "part").orderBy("p_partkey"), F.col("p_name"), path, one_file=True)
    return read_lines(spark, path, limit=100)


@query("select c_mktsegment as field, count(*)::BIGINT as n from customer group by 1")
def tsv_first_field(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "tsv")
    write_lines(table(spark, d, "customer"), F.concat_ws("\t", "c_mktsegment", "c_name"), path)
    fields = read_lines(spark, path).select(text.first_field(F.col("content")).alias("field")).where("field is not null")
    return fields.groupBy("field").agg(F.count("*").alias("n"))


@query("select doc_id::VARCHAR as id, lang as description, regexp_replace(text, '[\\r\\n]', '', 'g') as seq from documents")
def fasta_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "fasta")
    docs = table(spark, d, "documents")
    # a greater-than sign at a wrapped line's start would begin a record; this character is in no text
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("lang").alias("desc"), F.translate(F.regexp_replace("text", "[\r\n]", ""), ">", "\x01").alias("seq"))
    write_fasta(rows, path)
    return read_fasta(spark, path).select("id", F.col("desc").alias("description"), F.translate("seq", "\x01", ">").alias("seq"))


@query("select doc_id::VARCHAR as id, nullif(lang, '') as description, regexp_replace(text, '[\\r\\n]', '', 'g') as seq from documents")
def fastq_records(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "fastq")
    seq = F.regexp_replace("text", "[\r\n]", "")
    record = F.concat(F.lit("@"), F.col("doc_id").cast("string"), F.lit(" "), F.col("lang"), F.lit("\n"), seq, F.lit("\n+\n@I"))
    write_lines(table(spark, d, "documents"), record, path)
    return read_fastq(spark, path).select("id", F.col("desc").alias("description"), "seq")


@query("select '<record><id>' || c_custkey::VARCHAR || '</id><name>' || c_name || '</name></record>' as content from customer")
def xml_texts(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "xml")
    write_xml(table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), path)
    return source(spark, Xml(path, as_text=True))


@query("select c_custkey::VARCHAR as id, c_name as name, c_mktsegment as segment from customer")
def xml_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "xml")
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    write_xml(rows, path)
    return read_xml(spark, path, schema="id string, name string, segment string")


@query("select n_nationkey, n_name, n_regionkey from nation")
def jdbc_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    spec = Jdbc(f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", "nations", "org.apache.derby.iapi.jdbc.AutoloadedDriver")
    rows = table(spark, d, "nation").select(F.col("n_nationkey").alias("ID"), F.col("n_name").alias("NAME"), F.col("n_regionkey").alias("REGION"))
    write_jdbc(rows, spec)
    back = read_jdbc(spark, Jdbc(spec.url, "nations", spec.driver, "ID", 0, 25, 4))
    return back.select(F.col("ID").alias("n_nationkey"), F.col("NAME").alias("n_name"), F.col("REGION").alias("n_regionkey"))


@query("""
select array_to_string(list_transform(regexp_extract_all(hex(encode(text || chr(3))), '..'), lambda h: ('0x' || h)::INT), ',') as tokens,
  (strlen(text) + 1)::BIGINT as num_tokens, count(*)::BIGINT as n from documents group by all
""")
def tokenfile_u8_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    spec = TokenFile(fresh_path(spark, "tokens"), "bytes", unit=TokenUnit.U8)
    docs = table(spark, d, "documents").select(text.utf8(text.with_end(F.col("text"))).alias("tokens"))
    write_tokens(docs, spec)
    back = read_tokens(spark, f"{spec.base_path}/bytes_device_0", TokenUnit.U8)
    shown = F.concat_ws(",", F.col("tokens").cast("array<string>"))
    return back.select(shown.alias("tokens"), "num_tokens").groupBy("tokens", "num_tokens").agg(F.count("*").alias("n"))


@query("select o_orderkey % 65536 as a, o_custkey % 65536 as b, count(*)::BIGINT as n from orders group by all")
def tokenfile_u16_devices(spark: SparkSession, d: str) -> DataFrame:
    spec = TokenFile(fresh_path(spark, "tokens"), "orders", devices=3)
    rows = table(spark, d, "orders").repartition(6).select(F.array(*((F.col(c) % 65536).cast("int") for c in ("o_orderkey", "o_custkey"))).alias("tokens"))
    write_tokens(rows, spec)
    back = read_tokens(spark, ",".join(f"{spec.base_path}/orders_device_{k}" for k in range(3)))
    return back.select(F.col("tokens")[0].cast("long").alias("a"), F.col("tokens")[1].cast("long").alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))


@query("""
select (len(embedding) // 2)::BIGINT as num_tokens, array_to_string(list_transform(embedding, lambda x: floor(x::DOUBLE * 10000000)::BIGINT), ',') as units
from embeddings
""")
def tokenfile_f32_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    spec = TokenFile(fresh_path(spark, "tokens"), "vectors", unit=TokenUnit.F32, units_per_token=2)
    write_tokens(table(spark, d, "embeddings").select(F.col("embedding").alias("tokens")), spec)
    back = read_tokens(spark, f"{spec.base_path}/vectors_device_0", TokenUnit.F32, 2)
    units = F.transform("tokens", lambda x: F.floor(x.cast("double") * 10000000).cast("string"))
    return back.select("num_tokens", F.concat_ws(",", units).alias("units"))


@query("select line, num_tokens from (select (row_number() over (order by p_partkey) - 1)::BIGINT as line, length(p_name)::BIGINT as num_tokens from part) where line >= 10 and line < 20")
def tokenfile_lines(spark: SparkSession, d: str) -> DataFrame:
    """Some lines of a token file by number: the ranges outside are not read."""
    spec = TokenFile(fresh_path(spark, "tokens"), "names")
    rows = table(spark, d, "part").orderBy("p_partkey").select(F.transform(text.characters(F.col("p_name")), F.ascii).alias("tokens"))
    write_tokens(rows, spec)
    return read_tokens(spark, f"{spec.base_path}/names_device_0").where("line >= 10 and line < 20").select("line", "num_tokens")


# Keyed tables


@query("select 'doc:' || doc_id::VARCHAR as key, text as value from documents where text <> ''")
def kv_project(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text <> ''").select(text.key("doc:", F.col("doc_id")).alias("key"), F.col("text").alias("value"))


def _parties(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select(text.key("customer:", F.col("c_custkey")).alias("key"), F.col("c_name").alias("value"))
    suppliers = table(spark, d, "supplier").select(text.key("supplier:", F.col("s_suppkey")).alias("key"), F.col("s_name").alias("value"))
    return bag.union([customers, suppliers])


@query("""
select key, value from (select 'customer:' || c_custkey::VARCHAR as key, c_name as value from customer
  union all select 'supplier:' || s_suppkey::VARCHAR, s_name from supplier) where starts_with(key, 'customer:')
""")
def kv_prefix_scan(spark: SparkSession, d: str) -> DataFrame:
    return keyed.scan(_parties(spark, d), "customer:")


_DOCS = "select 'doc:' || doc_id::VARCHAR as key, text as value from documents"


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(text.key("doc:", F.col("doc_id")).alias("key"), F.col("text").alias("value"))


@query("select l.doc_id as doc_id, d.text as value from labels l join documents d on 'doc:' || l.doc_id::VARCHAR = 'doc:' || d.doc_id::VARCHAR")
def kv_lookup(spark: SparkSession, d: str) -> DataFrame:
    return keyed.lookup(table(spark, d, "labels"), text.key("doc:", F.col("doc_id")), _documents(spark, d))[0].select("doc_id", "value")


@query("select o_orderkey from orders where 'doc:' || o_orderkey::VARCHAR not in (select 'doc:' || doc_id::VARCHAR from documents)")
def kv_lookup_misses(spark: SparkSession, d: str) -> DataFrame:
    return keyed.lookup(table(spark, d, "orders").select("o_orderkey"), text.key("doc:", F.col("o_orderkey")), _documents(spark, d))[1]


@query("select key, arg_max(value, ord) as value from (select user_id::VARCHAR as key, event_type as value, event_id as ord from events) group by key")
def kv_upsert(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("value"), F.col("event_id").alias("seq"))
    return keyed.upsert(rows)


@query("""
select key, arg_max(value, ord) as value from (
  select s_suppkey::VARCHAR as key, s_name as value, 0 as ord from supplier
  union all select (c_custkey * 2)::VARCHAR, c_name, 1 from customer) group by key
""")
def kv_store_overwrite(spark: SparkSession, d: str) -> DataFrame:
    store = keyed.KeyedStore(spark, fresh_path(spark, "store"))
    store.write(table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("value")), 0)
    store.write(table(spark, d, "customer").select((F.col("c_custkey") * 2).cast("string").alias("key"), F.col("c_name").alias("value")), 0)
    return store.read(0)


@query("select (max(c_custkey) + 1)::BIGINT as next_id from customer")
def kv_next_id(spark: SparkSession, d: str) -> DataFrame:
    return _parties(spark, d).unionByName(spark.createDataFrame([("customer:x9", "")], "key string, value string")).agg(keyed.next_id("customer:"))


@query("""
with m as (select coalesce(max(o_orderkey) + 1, 0) b from orders)
select ((select b from m) + row_number() over (order by c_custkey) - 1)::BIGINT as id, c_name as value from customer
""")
def seq_id(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "orders").agg(F.coalesce(F.max("o_orderkey") + 1, F.lit(0)).alias("b")).collect()[0]["b"]
    return ids.dense_ids(table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("value")), ["c_custkey"], base).select("id", "value")


@query("""
select value, count(*)::BIGINT as n from (select s_name as value from supplier
  union all select c_name from customer, range(2)) group by value
""")
def mixture(spark: SparkSession, d: str) -> DataFrame:
    parts = [(table(spark, d, "supplier").select(F.col("s_name").alias("value")), 1), (table(spark, d, "customer").select(F.col("c_name").alias("value")), 2)]
    return bag.mixture(parts).groupBy("value").agg(F.count("*").alias("n"))


# JSON


@query("select event_id, (props ->> 'k')::DOUBLE as k from events where props ->> 'k' is not null")
def json_field(spark: SparkSession, d: str) -> DataFrame:
    value = json.field(json.parsed(F.col("props")), "k", "double")
    return table(spark, d, "events").select("event_id", value.alias("k")).where("k is not null")


@query("select doc_id, length(text)::BIGINT as n_chars, md5(text) as digest from documents")
def json_strict_text(spark: SparkSession, d: str) -> DataFrame:
    lines = spread(table(spark, d, "documents").select("doc_id", F.to_json(F.struct("text", "lang")).alias("line")))
    strict = lines.select("doc_id", json.strict_text("line").alias("text"))
    return strict.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


@query("select doc_id, md5(text) as digest from documents")
def json_native_text(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.to_json(F.struct("text", "lang")).alias("line"))
    return lines.select("doc_id", F.md5(json.text_field(F.col("line"))).alias("digest"))


@query("select o_orderkey, o_custkey::BIGINT as second, '[' || o_orderkey::VARCHAR || ',' || o_custkey::VARCHAR || ']' as line from orders")
def json_elements(spark: SparkSession, d: str) -> DataFrame:
    line = json.tokens_text(F.array("o_orderkey", "o_custkey"))
    return table(spark, d, "orders").select(
        "o_orderkey", F.try_variant_get(json.parsed(line), "$[1]", "bigint").alias("second"), line.alias("line")
    )


@query("select o_orderkey, case when o_totalprice::BIGINT <= 65535 then o_totalprice::BIGINT end as token from orders")
def json_u16_tokens(spark: SparkSession, d: str) -> DataFrame:
    # half-way prices are rounded alike by both engines only when they are whole
    whole = F.rint("o_totalprice").cast("long")
    tokens = json.u16_tokens(F.to_json(F.array(whole)))
    return table(spark, d, "orders").select("o_orderkey", F.get(tokens, 0).cast("long").alias("token"))


# Token files' index and prime


@query("""
select doc_id, num_tokens, coalesce(sum(num_tokens) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::BIGINT as byte_offset
from (select doc_id, (strlen(text) + 1)::BIGINT num_tokens from documents)
""")
def idx_offsets(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", (F.octet_length("text") + 1).cast("long").alias("num_tokens"))
    return ids.running_total(rows, "num_tokens", ["doc_id"], "byte_offset")


@query("""
with t as (select sum(strlen(text) + 1)::BIGINT total from documents), s as (select total, case when total > 3 * 512 then total // 512 - 1 else 0 end as slot from t),
cand as (select i from s, range(slot) r(i) where i % 3 = 2 and i > 1 and not exists
  (select 1 from range(2, cast(floor(sqrt(i)) as bigint) + 1) d(k) where i % k = 0))
select total, coalesce((select max(i) from cand), 0)::BIGINT as magic_prime from s
""")
def magic_prime(spark: SparkSession, d: str) -> DataFrame:
    total = table(spark, d, "documents").agg(F.sum(F.octet_length("text") + 1).alias("n")).collect()[0]["n"] or 0
    return spark.createDataFrame([(total, primes.magic_prime(total, 512))], "total long, magic_prime long")


# Soft labels


@query("""
select p_partkey, '[' || array_to_string(list_transform(regexp_extract_all(p_name, '.'), lambda x: '{"' || x || '":1}'), ',') || ']' as j from part
""")
def onehot_softlabel(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.to_json(softlabel.one_hot(F.col("p_name"))).alias("j"))


#: DuckDB macros of vectors in units of 1e-5: of a known label, and of one that counts as unknown.
_VECTORS = """
labels as (select ['<eos>','<pad>','<gap>','<unk>','<msk>','<fim_pre>','<fim_mid>','<fim_suf>','A','B','C','D','E','F','G','H','I','J','K','L','M',
  'N','O','P','Q','R','S','T','U','V','W','X','Y','Z','d','h','k','n','s'] as l),
one as (select c, f, case when list_position(l, c) > 0 then f + 30 * 0.002 else f + 31 * 0.002 end as total, coalesce(list_position(l, c), 4) as own,
  list_position(l, c) > 0 as known, l from asked, labels),
vec as (select c, f, array_to_string(list_transform(range(1, 40), lambda i:
  round(case when i = own then f when i > 8 then 0.002 else 0 end / total * 100000)::BIGINT), ',') as v from one)
"""
_END = "100000" + ",0" * 38


def _units(tokens: Column) -> Column:
    return F.concat_ws(",", F.transform(tokens, lambda x: F.round(x.cast("double") * 100000).cast("long").cast("string")))


def _counted_units(vectors: DataFrame) -> DataFrame:
    """The texts of ``vectors(tokens)`` and how many rows have each.  Equal vectors are counted before any is written out."""
    once = vectors.groupBy("tokens").agg(F.count("*").alias("n"))
    return once.groupBy(_units(F.col("tokens")).alias("units")).agg(F.sum("n").alias("n"))


@query(f"""
with ev as (select event_id, 'k' as c, case when (props ->> 'k')::DOUBLE = 0 then 0.002 else (props ->> 'k')::DOUBLE end as f from events),
asked as (select distinct c, f from ev), {_VECTORS}
select event_id, v || ',{_END}' as units from ev join vec using (c, f)
""")
def softlabel_vector(spark: SparkSession, d: str) -> DataFrame:
    document = F.concat(F.lit('{"softlabel_seq":['), F.col("props"), F.lit("]}"))
    labelled = table(spark, d, "events").select("event_id", softlabel.positions(document).alias("labels"))
    return softlabel.with_vectors(labelled, "labels", "u").select("event_id", _units(F.col("u")).alias("units"))


def _chain(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.lit(None).cast("string").alias("desc"), F.col("c_name").alias("seq"))
    labels = table(spark, d, "events").select(F.concat(F.lit("["), F.col("props"), F.lit("]")).alias("content"))
    return protein.genome_chain(spark, items, labels)


#: Vectors of one-hot sequences (names of customers) and of events' labels, twice each.
_CHAIN_SQL = f"""
with chars as (select c_custkey as id, unnest(regexp_extract_all(c_name, '.')) as c, unnest(range(length(c_name))) as i from customer),
ev as (select event_id, 'k' as c, case when (props ->> 'k')::DOUBLE = 0 then 0.002 else (props ->> 'k')::DOUBLE end as f from events),
asked as (select distinct c, 1.0::DOUBLE as f from chars union select c, f from ev), {_VECTORS},
every as (
  select string_agg(v, ',' order by i) || ',{_END}' as units from chars join vec on chars.c = vec.c and vec.f = 1 group by id
  union all select v || ',{_END}' from ev join vec using (c, f), range(2))
select units, count(*)::BIGINT as n from every group by units
"""


@query(_CHAIN_SQL)
def softlabel_chain(spark: SparkSession, d: str) -> DataFrame:
    return _counted_units(_chain(spark, d))


# Longest-match tokenizer


_MERGES = (" the", "the", "tion", " de", "ent", "en", "er", "th", "t", " ")
#: Longest first: an alternation then finds the longest match at each place.
_PIECE = "(?s)" + "|".join(sorted(_MERGES, key=lambda m: -len(m))) + "|."
_IDS = f"""
list_append(flatten(list_transform(regexp_extract_all(text, '{_PIECE}'), lambda p: case when list_contains({list(_MERGES)}, p)
  then [256 + list_position({list(_MERGES)}, p)] else list_transform(regexp_extract_all(hex(encode(p)), '..'), lambda h: ('0x' || h)::INT + 1) end)), 0)
"""


@query(f"select doc_id, len(ids)::BIGINT as n_tokens, array_to_string(ids, ',') as ids from (select doc_id, {_IDS} as ids from documents)")
def bpe_encode(spark: SparkSession, d: str) -> DataFrame:
    encode = bpe.encoder(spark, bpe.byte_vocabulary(_MERGES))
    rows = spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", encode("text").alias("ids"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.concat_ws(",", F.col("ids").cast("array<string>")).alias("ids"))


@query("select doc_id, md5(text) as digest from documents")
def bpe_decode(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = bpe.byte_vocabulary(["the", " the", " de", "en", "er", "tion"])
    encode, decode = bpe.encoder(spark, vocabulary, end=False), bpe.decoder(spark, vocabulary)
    return spread(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.md5(decode(encode("text"))).alias("digest"))


@query("""
select (i + 1)::INT as id, case when i < 128 then chr(i::INT) else '[Binary token [' || i::VARCHAR || ']]' end as token from range(256) r(i)
union all select 257, 'the'
""")
def bpe_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return bpe.byte_vocabulary(["the"]).frame(spark).select("id", "token")


# The runner


@query("""
select 'counts' as what, count(*)::VARCHAR as key, count_if(c_acctbal >= 0)::VARCHAR || ' ' || count_if(c_acctbal < 0)::VARCHAR as value from customer
union all select case when c_acctbal >= 0 then 'sent' else 'refused' end, c_custkey::VARCHAR, c_name from customer
""")
def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    """A run with two sinks, whose refused rows go to a third place; all are read back."""
    path, store, refused = (fresh_path(spark, x) for x in ("lines", "store", "refused"))
    write_lines(table(spark, d, "customer"), F.concat_ws("\t", "c_custkey", "c_name", "c_acctbal"), path)

    def transform(rows: DataFrame) -> DataFrame:
        key, value, balance = (F.split("content", "\t")[i] for i in range(3))
        return rows.select(key.alias("key"), value.alias("value"), F.when(balance.cast("double") < 0, F.concat_ws("\t", key, value)).alias(REFUSED))

    m = run(spark, [Lines(path)], transform, [KeyValue(store), Debug("run: ")], rejects=Lines(refused))
    counts = spark.createDataFrame([("counts", str(m.read), f"{m.sent} {m.rejected}")], "what string, key string, value string")
    sent = keyed.KeyedStore(spark, store).read(0).select(F.lit("sent").alias("what"), "key", "value")
    back = read_lines(spark, refused).select(F.lit("refused").alias("what"), F.split("content", "\t")[0].alias("key"), F.split("content", "\t")[1].alias("value"))
    return bag.union([counts, sent, back])


@query("select count(*)::BIGINT * 2 as read from supplier")
def run_drain(spark: SparkSession, d: str) -> DataFrame:
    """Without sinks the bag of all sources is counted."""
    path = fresh_path(spark, "lines")
    sink(table(spark, d, "supplier").select("s_name"), Lines(path))
    m = run(spark, [Lines(path), Lines(path)], lambda rows: (rows, None), [])
    return spark.createDataFrame([(m.read,)], "read long")


@query("select strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*)::BIGINT as n from events group by all")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """Tumbling windows of an event stream, all batches at once."""
    batch = table(spark, d, "events")
    events = spark.readStream.schema(batch.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    name = f"w{uuid.uuid4().hex}"
    counts = windowed_counts(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", "1 day", "event_type")
    stream = counts.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.table(name).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


# The tasks, from files to files


def _jsonl(spark: SparkSession, d: str) -> Lines:
    """All documents as JSON lines, and as many lines that are refused."""
    path = fresh_path(spark, "jsonl")
    docs = table(spark, d, "documents")
    good, bad = F.to_json(F.struct("text", "doc_id")), F.concat(F.lit('{"text":'), F.col("doc_id").cast("string"), F.lit("}"))
    write_lines(docs.select(F.explode(F.array(good, bad)).alias("line")), F.col("line"), path)
    return Lines(path)


def _told(spark: SparkSession, shown: DataFrame, m) -> DataFrame:
    """What a task wrote, and what it counted."""
    counts = spark.createDataFrame([(f"read {m.read}, sent {m.sent}, rejected {m.rejected}", 1)], "value string, n long")
    return shown.groupBy("value").agg(F.count("*").alias("n")).unionByName(counts)


_COUNTS = "select 'read ' || (2 * count(*))::VARCHAR || ', sent ' || count(*)::VARCHAR || ', rejected ' || count(*)::VARCHAR as value, 1::BIGINT as n from documents"


@query(f"select array_to_string({_IDS}, ',') as value, count(*)::BIGINT as n from documents group by 1 union all {_COUNTS}")
def task_jsonl_to_tokens(spark: SparkSession, d: str) -> DataFrame:
    out = TokenFile(fresh_path(spark, "task"), "text", devices=None, **texts.TEXT_TOKENS)
    m = texts.jsonl_to_tokens(spark, _jsonl(spark, d), bpe.byte_vocabulary(_MERGES), [out])
    return _told(spark, source(spark, out).select(F.concat_ws(",", F.col("tokens").cast("array<string>")).alias("value")), m)


@query("select array_to_string([o_orderkey % 65536, o_custkey % 65536], ',') as value, 1::BIGINT as n from orders order by o_orderkey limit 5")
def task_tokens_to_debug(spark: SparkSession, d: str) -> DataFrame:
    """The feature is the limit: the first five lines, which the debug sink counts."""
    at = TokenFile(fresh_path(spark, "task"), "orders")
    rows = table(spark, d, "orders").orderBy("o_orderkey").select(F.array(*((F.col(c) % 65536).cast("int") for c in ("o_orderkey", "o_custkey"))).alias("tokens"))
    write_tokens(rows, at)
    m = texts.tokens_to_debug(spark, at, Debug("tokens: "))
    first = source(spark, at).where(F.col("line") < m.sent)
    return first.select(F.concat_ws(",", json.u16_tokens(json.tokens_text(F.col("tokens"))).cast("array<string>")).alias("value"), F.lit(1).cast("long").alias("n"))


@query(f"select hex(encode(text || chr(3))) as value, count(*)::BIGINT as n from documents group by 1 union all {_COUNTS}")
def task_jsonl_to_bytes(spark: SparkSession, d: str) -> DataFrame:
    out = TokenFile(fresh_path(spark, "task"), "bytes", devices=3, **texts.BYTE_TOKENS)
    m = texts.jsonl_to_bytes(spark, _jsonl(spark, d), [out])
    return _told(spark, source(spark, out).select(F.array_join(F.transform("tokens", lambda x: F.lpad(F.hex(x), 2, "0")), "").alias("value")), m)


@query("""
with b as (select unnest(regexp_extract_all(hex(encode(text || chr(3))), '..')) h from documents),
n as (select ('0x' || h)::INT byte, count(*) c from b group by 1)
select r.i::INT as byte, coalesce(n.c, 0)::BIGINT as count from range(256) r(i) left join n on n.byte = r.i
""")
def task_jsonl_to_histogram(spark: SparkSession, d: str) -> DataFrame:
    path = fresh_path(spark, "task")
    texts.jsonl_to_histogram(spark, _jsonl(spark, d), path)
    return spark.read.schema("byte int, count long").csv(path)


def _names(spark: SparkSession, d: str) -> tuple[Fasta, Fasta]:
    """Customers and suppliers as FASTA records of their names, and a record without an id."""
    paths = []
    for name, key, seq in (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name")):
        rows = table(spark, d, name).select(F.concat(F.lit(name[0]), F.col(key).cast("string")).alias("id"), F.lit("of a table").alias("desc"), F.col(seq).alias("seq"))
        paths.append(fresh_path(spark, "names"))
        write_fasta(rows.unionByName(spark.createDataFrame([("", "no id", "AC")], rows.schema)), paths[-1])
    return Fasta(paths[0]), Fasta(paths[1])


_NAMES = "(select 'c' || c_custkey::VARCHAR as id, c_name as seq from customer union all select 's' || s_suppkey::VARCHAR, s_name from supplier)"
_ONE_HOT = """'[' || array_to_string(list_transform(regexp_extract_all(seq, '.'), lambda x: '{"' || x || '":1}'), ',') || ']'"""
_DOCUMENT = f"""'{{"protein_id_list":["' || id || '"],"softlabel_seq":' || {_ONE_HOT} || '}}'"""


@query(f"select 'softlabel:' || id as key, {_DOCUMENT} as value from {_NAMES} where id[1] = 'c' union all select 'refused', '> no id|AC'")
def task_genome_singletons(spark: SparkSession, d: str) -> DataFrame:
    store, refused = fresh_path(spark, "store"), fresh_path(spark, "refused")
    protein.genome_singletons(spark, _names(spark, d)[0], [KeyValue(store)], rejects=Lines(refused))
    back = read_lines(spark, refused).agg(F.lit("refused").alias("key"), F.array_join(F.sort_array(F.collect_list("content")), "|").alias("value"))
    return keyed.KeyedStore(spark, store).read(0).unionByName(back.select("key", F.regexp_replace("value", r"^([^>|]*)\|(>.*)$", "$2|$1").alias("value")))


@query(f"select 'protein:' || id as key, seq as value from {_NAMES}")
def task_nr_eukaryota(spark: SparkSession, d: str) -> DataFrame:
    store = fresh_path(spark, "store")
    protein.eukaryota(spark, [*_names(spark, d), Fasta(fresh_path(spark, "none") + "/eukaryota.*.fa")], [KeyValue(store)])
    return keyed.KeyedStore(spark, store).read(0)


def _labels(spark: SparkSession, d: str, pairs: bool) -> Lines:
    """Events' labels as JSON lines, and lines that are refused."""
    path = fresh_path(spark, "labels")
    labels = F.concat(F.lit("["), F.col("props"), F.lit("]"))
    good = F.concat(F.lit('[["e'), F.col("event_id").cast("string"), F.lit('"],'), labels, F.lit("]")) if pairs else labels
    write_lines(table(spark, d, "events").select(F.explode(F.array(good, F.lit("no json"))).alias("line")), F.col("line"), path)
    return Lines(path)


def _keys_and_values(store: DataFrame) -> DataFrame:
    """Values with their numbers of rows, and the dense keys: how many, the least and the greatest."""
    number = text.key_number(F.col("key"), protein.SOFTLABEL)
    keys = store.agg(F.concat_ws(" ", F.count_distinct(number), F.min(number), F.max(number)).alias("value"), F.lit(1).cast("long").alias("n"))
    return store.groupBy("value").agg(F.count("*").alias("n")).unionByName(keys)


def _numbered_sql(values: str) -> str:
    return f"""
with v as ({values})
select value, count(*)::BIGINT as n from v group by value
union all select count(*)::VARCHAR || ' 0 ' || (count(*) - 1)::VARCHAR, 1 from v
"""


_EVENTS = """(select 'e' || event_id::VARCHAR as id, '[' || replace(props, ' ', '') || ']' as labels from events)"""
_GENOME_LABELS = f"""select '{{"protein_id_list":["?"],"softlabel_seq":' || labels || '}}' as value from {_EVENTS}"""
_NR_LABELS = f"""select '{{"protein_id_list":["' || id || '"],"softlabel_seq":' || labels || '}}' as value from {_EVENTS}"""


@query(_numbered_sql(_GENOME_LABELS))
def task_genome_softlabels(spark: SparkSession, d: str) -> DataFrame:
    store = fresh_path(spark, "store")
    protein.labels_to_store(spark, _labels(spark, d, False), KeyValue(store, 1), pairs=False)
    return _keys_and_values(keyed.KeyedStore(spark, store).read(1))


@query(_numbered_sql(_NR_LABELS))
def task_nr_softlabels(spark: SparkSession, d: str) -> DataFrame:
    store = fresh_path(spark, "store")
    protein.labels_to_store(spark, _labels(spark, d, True), KeyValue(store, 2), pairs=True)
    return _keys_and_values(keyed.KeyedStore(spark, store).read(2))


def _genome_store(spark: SparkSession, d: str) -> keyed.KeyedStore:
    store = keyed.KeyedStore(spark, fresh_path(spark, "store"))
    protein.genome_singletons(spark, _names(spark, d)[0], [KeyValue(store.path, 0)])
    protein.labels_to_store(spark, _labels(spark, d, False), KeyValue(store.path, 1), pairs=False)
    protein.mix_stores(spark, store, {0: 1, 1: 2}, protein.SOFTLABEL, 2)
    return store


@query(_numbered_sql(f"select {_DOCUMENT} as value from {_NAMES} where id[1] = 'c' union all select value from ({_GENOME_LABELS}), range(2)"))
def task_genome_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _keys_and_values(_genome_store(spark, d).read(2))


def _written_vectors(spark: SparkSession, store: keyed.KeyedStore, db: int, context: int | None) -> DataFrame:
    out = TokenFile(fresh_path(spark, "task"), "vectors", devices=None, unit=TokenUnit.F32, units_per_token=softlabel.WIDTH, context_length=context)
    protein.store_to_vectors(spark, KeyValue(store.path, db, protein.SOFTLABEL), [out])
    return _counted_units(source(spark, out))


@query(_CHAIN_SQL)
def task_genome_vectors(spark: SparkSession, d: str) -> DataFrame:
    return _written_vectors(spark, _genome_store(spark, d), 2, 4096)


def _nr_store(spark: SparkSession, d: str) -> keyed.KeyedStore:
    """Names by id in 0, those of asked ids in 1 (with a blank line and an id that nothing has), labels in 2, their mixture in 3."""
    store = keyed.KeyedStore(spark, fresh_path(spark, "store"))
    protein.eukaryota(spark, list(_names(spark, d)), [KeyValue(store.path, 0)])
    path = fresh_path(spark, "tsv")
    asked = table(spark, d, "customer").select(F.explode(F.array(F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("\tmore")), F.lit(" "), F.lit("x0\tno"))).alias("line"))
    write_lines(asked, F.col("line"), path)
    protein.singletons_by_lookup(spark, Lines(path), store, 0, 1)
    protein.labels_to_store(spark, _labels(spark, d, True), KeyValue(store.path, 2), pairs=True)
    return store


@query(_numbered_sql(f"select {_DOCUMENT} as value from {_NAMES} where id[1] = 'c'"))
def task_nr_singletons(spark: SparkSession, d: str) -> DataFrame:
    return _keys_and_values(_nr_store(spark, d).read(1))


@query(_numbered_sql(f"select {_DOCUMENT} as value from {_NAMES} where id[1] = 'c' union all select value from ({_NR_LABELS}), range(4)"))
def task_nr_mixture(spark: SparkSession, d: str) -> DataFrame:
    store = _nr_store(spark, d)
    protein.mix_stores(spark, store, {1: 1, 2: 4}, protein.SOFTLABEL, 3)
    return _keys_and_values(store.read(3))


@query(_CHAIN_SQL.replace("range(2)", "range(4)"))
def task_nr_vectors(spark: SparkSession, d: str) -> DataFrame:
    store = _nr_store(spark, d)
    protein.mix_stores(spark, store, {1: 1, 2: 4}, protein.SOFTLABEL, 3)
    return _written_vectors(spark, store, 3, None)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The whole protein flow: one-hot and labelled documents, mixed, as vectors."""
    return _chain(spark, d)
