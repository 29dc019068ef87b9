"""Readers, writers and stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.codecs import codes_to_ids
from ..functions.text import AUDIO_EXTENSIONS
from ..operators import pack as P
from ..operators.mixture import parse_count_logs, token_totals
from ..session import scratch_path
from ..sources import codec_files as C
from ..sources import manifests as M
from ..sources import store as ST
from ..sources.files import write_files
from . import fixtures as X
from .registry import query

PACK = P.PackConfig(128)


@query(
    "s01_read_manifest",
    "select conv_id, turn, role, text from conversations",
)
def read_manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    X.table(spark, sf, "conversations").write.option("compression", "gzip").json(path)
    return M.read_manifest(spark, f"{path}/*.json.gz", "conv_id bigint, turn bigint, role string, text string")


_LINE = "to_json({'doc_id': doc_id, 'source': source, 'n_chars': n_chars})::varchar"


@query(
    "s02_malformed_lines",
    "select 'good' as status, doc_id, source, n_chars, '' as line from documents where doc_id % 7 <> 3 union all"
    " select 'bad', null, null, null, line[1:length(line) - 5] from"
    f" (select {_LINE} as line, doc_id from documents) where doc_id % 7 = 3",
)
def malformed_lines(spark, sf):
    line = F.to_json(F.struct("doc_id", "source", "n_chars"))
    cut = F.when(F.col("doc_id") % 7 == 3, F.substring(line, F.lit(1), F.length(line) - 5)).otherwise(line)
    path = scratch_path(spark, "lines")
    X.documents(spark, sf).select(cut.alias("value")).write.text(path)
    good, bad = M.read_manifest(spark, path, "doc_id bigint, source string, n_chars bigint", "quarantine")
    return good.select(F.lit("good").alias("status"), "*", F.lit("").alias("line")).unionByName(
        bad.select(F.lit("bad").alias("status"), "line"), allowMissingColumns=True
    )


@query(
    "s03_read_codec",
    X.with_views("codes", f"select 'npy/' || vec_id || '.npy' as path, {X.sql_matrix('codec')} as codec from codes"),
)
def read_codec(spark, sf):
    files = X.codes(spark, sf).select(
        F.concat(F.lit("npy/"), F.col("vec_id").cast("string"), F.lit(".npy")).alias("path"),
        C.encode_npy(F.col("codec")).alias("content"),
    )
    return C.decode_npy(files).select("path", X.joined_matrix("codec").alias("codec"))


# Files as they are exchanged, some of them damaged: cut off, of reals, of one dimension, or with 64-bit values.
@query(
    "s03_codec_files",
    X.with_views(
        "codes",
        "select vec_id || '.npy' as file, case vec_id % 9 when 1 then 'unreadable' when 2 then 'type' when 3 then 'shape' when 4 then 'range' end as problem,"
        f" case when vec_id % 9 not in (1, 2, 3, 4) then {X.sql_matrix('codec')} end as codec from codes",
    ),
)
def codec_files(spark, sf):
    codec, fault = F.col("codec"), F.col("vec_id") % 9
    far = F.transform(codec, lambda r: F.transform(r, lambda v: v.cast("bigint") + (1 << 40)))
    good = C.encode_npy(codec)
    content = (
        F.when(fault == 1, F.substring(good, F.lit(1), F.octet_length(good) - 3)).when(fault == 2, C.encode_npy(codec, "float32"))
        .when(fault == 3, C.encode_npy(F.flatten(codec))).when(fault == 4, C.encode_npy(far, "int64")).otherwise(good)
    )
    folder = scratch_path(spark, "codecs")
    name = F.concat((F.col("vec_id") % 4).cast("string"), F.lit("/"), F.col("vec_id").cast("string"), F.lit(".npy"))
    write_files(X.codes(spark, sf).select(name.alias("name"), content.alias("content")), folder)
    return C.read_codec(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "problem", X.joined_matrix("codec").alias("codec"))


@query(
    "s04_list_files",
    X.with_views("names", "select file_no, file from names where lower(regexp_extract(file, '(\\.[^./]*)$', 1)) in ('.mp3', '.flac')"),
)
def list_files(spark, sf):
    return M.filter_files(X.names(spark, sf), "file", [e for e in AUDIO_EXTENSIONS if e != ".wav"])


@query("s04_written_files", "select vec_id || '.npy' as file from embeddings where vec_id % 3 = 0 union all select vec_id || '.NPY' from embeddings where vec_id % 3 = 1")
def written_files(spark, sf):
    folder, n = scratch_path(spark, "listed"), F.col("vec_id")
    ending = F.when(n % 3 == 0, ".npy").when(n % 3 == 1, ".NPY").otherwise(".txt")
    rows = X.table(spark, sf, "embeddings").select(F.concat((n % 5).cast("string"), F.lit("/"), n.cast("string"), ending).alias("name"), F.lit("x").alias("content"))
    write_files(rows, folder)
    return M.list_files(spark, folder, [".npy"]).select(F.element_at(F.split("path", "/"), -1).alias("file"))


@query(
    "s05_codec_records",
    X.with_views(
        "cells",
        "select vec_id::varchar as src, 'dac16k' as codec, string_agg((code + 32022 + k * 1024)::varchar, ' ' order by t, k) as text"
        " from cells group by vec_id",
    ),
)
def codec_records(spark, sf):
    path = scratch_path(spark, "records")
    codes = X.codes(spark, sf).withColumn("vec_id", F.col("vec_id").cast("string"))
    C.codec_to_records(codes, "vec_id", "codec", X.FOUR).write.json(path)
    back = M.read_manifest(spark, path, "text array<int>, src string, codec string")
    return back.select("src", "codec", X.joined("text").alias("text"))


@query(
    "s06_write_sequences",
    X.with_views(
        "toks lens",
        "select dataset, (select count(*) from lens l where l.dataset = toks.dataset) as n_sequences, count(*) as n_tokens,"
        " sum(id)::bigint as id_sum from toks group by dataset",
    ),
)
def write_sequences(spark, sf):
    path = scratch_path(spark, "store")
    ST.write_sequences(X.seqs(spark, sf), path)
    stored = ST.read_sequences(spark, path)
    ids = F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return stored.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.sum(ids).cast("bigint").alias("id_sum"),
    )


@query(
    "s07_take_sequences",
    X.with_views(
        "toks",
        "select l.doc_id, l.off as \"offset\", l.len as length, coalesce(string_agg(t.id::varchar, ' ' order by t.pos), '') as tokens from"
        " (select doc_id, (doc_id % 5)::integer as off, case when toxic = 1 then null else (3 + quality * 4)::integer end as len"
        " from labels) l left join toks t on t.doc_id = l.doc_id and t.pos >= l.off and (l.len is null or t.pos < l.off + l.len)"
        " group by all",
    ),
)
def take_sequences(spark, sf):
    requests = X.table(spark, sf, "labels").select(
        "doc_id",
        (F.col("doc_id") % 5).cast("int").alias("offset"),
        F.when(F.col("toxic") != 1, 3 + F.col("quality") * 4).cast("int").alias("length"),
    )
    got = ST.take_sequences(X.seqs(spark, sf), requests, ["doc_id"])
    return got.select("doc_id", "offset", "length", X.joined("tokens").alias("tokens"))


@query(
    "s07_take_by_dataset",
    X.with_views(
        "linew toks",
        "select l.dataset, l.doc_id, l.i::integer as seq_no, coalesce(string_agg(t.id::varchar, ' ' order by t.pos), '') as tokens from linew l"
        " left join toks t on t.doc_id = l.doc_id and t.pos >= l.b + l.doc_id % 3 and t.pos < l.b + l.n and (l.i % 2 = 0 or"
        " t.pos < l.b + l.doc_id % 3 + 2) group by all",
    ),
)
def take_by_dataset(spark, sf):
    lines = X.line_seqs(spark, sf)
    # A second dataset with the same document and sequence numbers, but other tokens.
    other = lines.withColumn("dataset", F.concat(F.lit("copy_"), "dataset")).withColumn("tokens", F.transform("tokens", lambda t: t + 1))
    requests = lines.select(
        "dataset", "doc_id", "seq_no", (F.col("doc_id") % 3).cast("int").alias("offset"),
        F.when(F.col("seq_no") % 2 != 0, 2).cast("int").alias("length"),
    )
    got = ST.take_sequences(lines.unionByName(other), requests)
    return got.select("dataset", "doc_id", "seq_no", X.joined("tokens").alias("tokens"))


# Requests for one document in a hundred, from a store in 64 ranges: only files that can hold one are read.
@query(
    "s07_point_reads",
    X.with_views(
        "toks",
        "select l.dataset, l.doc_id, coalesce(string_agg(t.id::varchar, ' ' order by t.pos), '') as tokens, true as few_files from"
        " (select source as dataset, doc_id from documents where doc_id < (select max(doc_id) // 100 from documents)) l"
        " left join toks t on t.doc_id = l.doc_id and t.pos < 20 group by l.dataset, l.doc_id",
    ),
)
def point_reads(spark, sf):
    path = scratch_path(spark, "clustered")
    ST.write_sequences(X.seqs(spark, sf), path, cluster="doc_id", files=64)
    docs = X.documents(spark, sf).select(F.col("source").alias("dataset"), "doc_id")
    last = docs.agg(F.expr("max(doc_id) div 100").alias("last"))
    requests = docs.join(F.broadcast(last), F.col("doc_id") < F.col("last")).select("dataset", "doc_id", F.lit(0).alias("offset"), F.lit(20).alias("length"))
    files = ST.read_requested(spark, path, requests)
    few = len(files.inputFiles()) <= len(ST.read_sequences(spark, path).inputFiles()) // 2
    got = ST.take_sequences(files, requests)
    return got.select("dataset", "doc_id", X.joined("tokens").alias("tokens"), F.lit(few).alias("few_files"))


@query(
    "s08_write_stats",
    X.with_views(
        "lens",
        "select coalesce(dataset, '<all>') as dataset, sum(n_tokens)::bigint as n_tokens, count(*) as n_sequences from lens"
        " group by rollup (dataset)",
    ),
)
def write_stats(spark, sf):
    path = scratch_path(spark, "stats")
    totals = token_totals(X.lengths(spark, sf)).withColumn("dataset", F.coalesce("dataset", F.lit("<all>")))
    ST.write_stats(totals, path)
    return M.read_manifest(spark, path, "dataset string, n_tokens bigint, n_sequences bigint")


# All samples of one pass per dataset: sample i holds flat tokens i*L .. i*L+L.
PACKED = (
    "select f.dataset, s.sample, string_agg(f.id::varchar, ' ' order by f.place) as tokens from flat f,"
    " unnest(case when f.place % {L} = 0 and f.place > 0 then [f.place // {L}, f.place // {L} - 1] else [f.place // {L}] end) as s(sample)"
    " where s.sample < (f.total - 1) // {L} group by all"
)


@query("s09_write_samples", X.with_views("flat", PACKED.format(L=128)))
def write_samples(spark, sf):
    path = scratch_path(spark, "samples")
    ST.write_samples(P.pack_samples(X.seqs(spark, sf), PACK), path)
    return spark.read.parquet(path).select("dataset", "sample", X.joined("tokens").alias("tokens"))


def _log(path, total):
    return F.concat(F.lit("loading\nCounting tokens in  ./"), path, F.lit("\n\n  0%|  | 0/10 [00:00<?, ?it/s]\n"), total)


@query("s10_parse_count_logs", X.with_views("counts", "select './' || path as path, n_tokens from counts"))
def parse_logs(spark, sf):
    _, counts = X.mix(spark, sf)
    total = F.concat(F.lit("Total number of tokens:  "), F.col("n_tokens").cast("string"), F.lit("\n"))
    return parse_count_logs(counts.select(_log(F.col("path"), total).alias("value")))


# One log file per source, language and last digit; some broke off before the total, some name no path, some are empty,
# some files are no logs.
_LOGS = "lg as (select source || '.' || lang || '.' || (doc_id % 10) as name, (doc_id % 10)::integer as m, sum(n_chars)::bigint as n from documents group by all)"


@query(
    "s10_log_files",
    f"with {_LOGS} select 'count.' || name || '.log' as file, case when m not in (3, 4, 6) then './' || name || '.bin' end as path,"
    " case when m not in (3, 4, 6) then n end as n_tokens, case m when 3 then 'no token total' when 4 then 'no path' when 6 then 'no path' end as problem from lg where m <> 5",
)
def log_files(spark, sf):
    folder, m = scratch_path(spark, "logs"), F.col("m")
    name = F.concat_ws(".", "source", "lang", (F.col("doc_id") % 10).cast("string"))
    counts = X.documents(spark, sf).groupBy(name.alias("name"), (F.col("doc_id") % 10).alias("m")).agg(F.sum("n_chars").cast("bigint").alias("n"))
    total = F.concat(F.lit("Total number of tokens:  "), F.col("n").cast("string"), F.lit("\n"))
    whole = _log(F.concat("name", F.lit(".bin")), F.when(m == 3, F.lit("")).otherwise(total))
    text = F.when(m == 4, total).when(m == 6, "").otherwise(whole)
    file = F.concat(F.when(m == 5, "other.").otherwise("count."), "name", F.lit(".log"))
    write_files(counts.select(file.alias("name"), text.alias("content")), folder)
    good, bad = parse_count_logs(ST.read_count_logs(spark, folder), on_error="quarantine", file="file")
    return good.unionByName(bad, allowMissingColumns=True).select("file", "path", F.col("n_tokens"), "problem")


@query(
    "u01_append_store",
    X.with_views(
        "lens",
        "select store_no, doc_id, n_tokens, row_number() over (order by store_no, doc_id) - 1 as new_id from"
        " (select (case when dataset < 'src5' then 0 else 1 end)::integer as store_no, doc_id, n_tokens from lens)",
    ),
)
def append_store(spark, sf):
    all_rows = X.lengths(spark, sf).select("doc_id", "dataset", "n_tokens")
    stores = [all_rows.where(F.col("dataset") < "src5"), all_rows.where(F.col("dataset") >= "src5")]
    return ST.append_stores(stores).select("store_no", "doc_id", "n_tokens", "new_id")


@query(
    "u01_append_sequences",
    X.with_views(
        "linew",
        "select store_no, dataset, doc_id, seq_no, dense_rank() over (order by store_no, doc_id) - 1 as new_id from"
        " (select (case when dataset < 'src5' then 0 else 1 end)::integer as store_no, dataset, doc_id, i::integer as seq_no from linew)",
    ),
)
def append_sequences(spark, sf):
    rows = X.line_seqs(spark, sf).drop("tokens")
    stores = [rows.where(F.col("dataset") < "src5"), rows.where(F.col("dataset") >= "src5")]
    return ST.append_stores(stores).select("store_no", "dataset", "doc_id", "seq_no", "new_id")


@query(
    "u04_partition_lines",
    "select doc_id, ((row_number() over (order by doc_id) - 1) % 7)::integer as dealt,"
    " ((row_number() over (order by doc_id) - 1) // ((count(*) over () + 6) // 7))::integer as block from documents",
)
def partition_lines(spark, sf):
    lines = X.documents(spark, sf).select("doc_id")
    dealt = M.assign_partition(lines, "doc_id", 7, out="dealt")
    blocks = M.assign_partition(lines, "doc_id", 7, "sequential", "block")
    return dealt.join(blocks, "doc_id")


@query(
    "f21_pointers",
    X.with_views(
        "lens",
        "select dataset, doc_id, (2 * coalesce(sum(n_tokens) over (partition by dataset order by doc_id rows between"
        " unbounded preceding and 1 preceding), 0))::bigint as pointer from lens",
    ),
)
def pointers(spark, sf):
    return ST.with_pointers(X.lengths(spark, sf), cardinality=32000).select("dataset", "doc_id", "pointer")


@query(
    "f04_codes_to_ids",
    X.with_views(
        "cells",
        "select vec_id, string_agg((code + 45334 + k * 1024)::varchar, ' ' order by t, k) filter (where k < 4) as ids,"
        " string_agg((code + 45334 + k * 1024)::varchar, ' ' order by t, k) filter (where k in (1, 2)) as middle"
        " from cells group by vec_id",
    ),
)
def f04(spark, sf):
    middle = X.CodecOptions("xcodec", 1, 2)
    return X.codes(spark, sf).select(
        "vec_id",
        X.joined(codes_to_ids(F.col("codec"), X.FIRST_LAYERS)).alias("ids"),
        X.joined(codes_to_ids(F.col("codec"), middle)).alias("middle"),
    )
