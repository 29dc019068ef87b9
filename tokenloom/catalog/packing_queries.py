"""Packing, splitting, blending, sentence mapping and mixture planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import hash_bits
from ..operators import blend as B
from ..operators import mapping as MP
from ..operators import mixture as MX
from ..operators import order as O
from ..operators import pack as P
from ..operators import split as SP
from . import fixtures as X
from .registry import query
from .source_queries import PACK, PACKED

L = PACK.sequence_length
SPLIT = "960,30,10"


def _ctes(views: str, more: str, body: str) -> str:
    return X.with_views(views, "select 1").removesuffix("select 1").rstrip() + f", {more} {body}"


def _hash(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::bigint"


# ---- packing ---------------------------------------------------------------------------------


@query("a01_pack", X.with_views("flat", PACKED.format(L=L)))
def a01(spark, sf):
    return P.pack_samples(X.seqs(spark, sf), PACK).select("dataset", "sample", X.joined("tokens").alias("tokens"))


@query("a01_pack_long", X.with_views("flat", PACKED.format(L=2048)))
def a01_long(spark, sf):
    packed = P.pack_samples(X.seqs(spark, sf), P.PackConfig(2048))
    return packed.select("dataset", "sample", X.joined("tokens").alias("tokens"))


@query("a01_pack_sequences", X.with_views("flat", PACKED.format(L=L)))
def a01_sequences(spark, sf):
    packed = P.pack_samples(X.line_seqs(spark, sf), P.PackConfig(L, ties=("seq_no",)))
    return packed.select("dataset", "sample", X.joined("tokens").alias("tokens"))


_SAMPLE_DOCS = PACKED.format(L=L).replace(
    "string_agg(f.id::varchar, ' ' order by f.place) as tokens", "array_to_string(list(distinct f.doc_id order by f.doc_id), ' ') as doc_ids"
)


@query("a34_sample_documents", X.with_views("flat", _SAMPLE_DOCS))
def a34(spark, sf):
    return P.pack_samples(X.seqs(spark, sf), PACK).select("dataset", "sample", X.joined("doc_ids").alias("doc_ids"))


@query(
    "a02_sample_index",
    X.with_views(
        "flat",
        f"select dataset, place // {L} as sample, doc_pos, (place - start)::bigint as \"offset\" from flat where place % {L} = 0 and place // {L} <= (total - 1) // {L}",
    ),
)
def a02(spark, sf):
    index = P.tile_epochs(X.lengths(spark, sf), PACK)
    return P.sample_index(index, PACK).select("dataset", "sample", "doc_pos", F.col("offset").cast("bigint").alias("offset"))


@query(
    "j06_sample_parts",
    X.with_views(
        "flat",
        "select dataset, sample, doc_id, min(place - start)::integer as \"offset\", count(*)::integer as length from (select f.*, s.sample from flat f,"
        f" unnest(case when f.place % {L} = 0 and f.place > 0 then [f.place // {L}, f.place // {L} - 1] else [f.place // {L}] end) as s(sample)"
        f" where s.sample < (f.total - 1) // {L}) group by dataset, sample, doc_id",
    ),
)
def j06(spark, sf):
    index = P.tile_epochs(X.lengths(spark, sf), PACK)
    return P.sample_parts(index, PACK).select("dataset", "sample", "doc_id", "offset", "length")


# Requests that need one to three epochs, different per dataset.
_WANT = f"greatest((tpe // {L}) * (2 + regexp_extract(dataset, '(\\d+)$', 1)::bigint % 5) // 2, 1)"
_PLAN = (
    f"tot as (select dataset, sum(n_tokens)::bigint as tpe, count(*) as docs from lens group by dataset), want as (select *, {_WANT} as want from tot),"
    f" ep as (select *, greatest((want * {L} + 1 + tpe - 1) // tpe, 1) as epochs from want),"
    f" plan as (select *, (epochs * tpe - 1) // {L} as n_samples, case when epochs > 1 then ((epochs - 1) * tpe - 1) // {L} else 0 end as before_last,"
    f" (tpe - 1) // {L} as per_epoch from ep),"
    " dec as (select *, epochs > 1 and want - before_last < trunc(0.80::double * per_epoch) as separate from plan)"
)


def _want(spark, sf):
    """Token totals with the number of samples wanted of each dataset."""
    totals = P.tokens_per_epoch(X.lengths(spark, sf), PACK)
    number = F.regexp_extract("dataset", r"(\d+)$", 1).cast("bigint")
    per_epoch = F.call_function("div", F.col("tokens_per_epoch"), F.lit(L))
    return totals.withColumn("want", F.greatest(F.call_function("div", per_epoch * (2 + number % 5), F.lit(2)), F.lit(1)))


@query("g02_tokens_per_epoch", X.with_views(
    "lens",
    "select dataset, sum(n_tokens)::bigint as tokens_per_epoch from (select *, row_number() over (partition by dataset order by doc_id) - 1 as r,"
    " count(*) over (partition by dataset) as n from lens) where r < round_even(0.96::double * n, 0) group by dataset",
))
def g02(spark, sf):
    train = SP.assign_split(X.lengths(spark, sf), SP.split_bounds(SPLIT), "doc_id", ["dataset"])
    return P.tokens_per_epoch(train.where(F.col("split") == "train"), PACK)


@query("g03_epochs", _ctes("lens", _PLAN, "select dataset, want, epochs from plan"))
def g03(spark, sf):
    return P.epoch_plan(_want(spark, sf), PACK, F.col("want")).select("dataset", "want", "epochs")


@query("a03_sample_count", _ctes("lens", _PLAN, "select dataset, n_samples, per_epoch from plan"))
def a03(spark, sf):
    plan = P.epoch_plan(_want(spark, sf), PACK, F.col("want"))
    return plan.select("dataset", "n_samples", F.col("samples_per_epoch").alias("per_epoch"))


@query("a05_separate_epoch", _ctes("lens", _PLAN, "select dataset, epochs, before_last, separate from dec"))
def a05(spark, sf):
    plan = P.epoch_plan(_want(spark, sf), PACK, F.col("want"))
    return plan.select(
        "dataset", "epochs", F.col("samples_before_last").cast("bigint").alias("before_last"), F.col("separate_final_epoch").alias("separate")
    )


def _wanted_lengths(spark, sf):
    return X.lengths(spark, sf).join(_want(spark, sf).select("dataset", "want"), "dataset")


@query(
    "a04_tile_epochs",
    _ctes(
        "lens",
        _PLAN,
        "select l.dataset, doc_id, e.epoch, (sum(n_tokens) over w - n_tokens)::bigint as start, row_number() over w - 1 as doc_pos from lens l"
        " join dec using (dataset), unnest(range(0, epochs)) as e(epoch) window w as (partition by l.dataset order by e.epoch, doc_id)",
    ),
)
def a04(spark, sf):
    index = P.tile_epochs(_wanted_lengths(spark, sf), PACK, F.col("want"))
    return index.select("dataset", "doc_id", "epoch", "start", "doc_pos")


@query(
    "a04_shuffled_epochs",
    _ctes(
        "lens",
        _PLAN,
        "select l.dataset, doc_id, e.epoch, (sum(n_tokens) over w - n_tokens)::bigint as start, row_number() over w - 1 as doc_pos from lens l"
        " join dec using (dataset), unnest(range(0, epochs)) as e(epoch) window w as (partition by l.dataset order by"
        " (separate and e.epoch = epochs - 1), " + _hash("'1234:' || doc_id || ':' || e.epoch") + ", doc_id, e.epoch"
        " rows between unbounded preceding and current row)",
    ),
)
def a04_shuffled(spark, sf):
    cfg = P.PackConfig(L, shuffle_documents=True)
    index = P.tile_epochs(_wanted_lengths(spark, sf), cfg, F.col("want"))
    return index.select("dataset", "doc_id", "epoch", "start", "doc_pos")


_SAMPLES = "smp as (select dataset, unnest(range(0, n_samples)) as sample, before_last, n_samples, separate from dec)"


def _sample_numbers(spark, sf):
    plan = P.epoch_plan(_want(spark, sf), PACK, F.col("want")).where(F.col("n_samples") > 0)
    first = F.when(F.col("separate_final_epoch"), F.col("samples_before_last")).otherwise(F.col("n_samples"))
    rows = plan.select("dataset", first.cast("bigint").alias("first_range"), F.sequence(F.lit(0).cast("bigint"), F.col("n_samples") - 1).alias("s"))
    return rows.select("dataset", "first_range", F.explode("s").alias("sample"))


@query(
    "a06_shuffle_samples",
    _ctes(
        "lens",
        f"{_PLAN}, {_SAMPLES}",
        "select dataset, sample, row_number() over (partition by dataset order by (separate and sample >= before_last), "
        + _hash("'1234sample:' || sample")
        + ", sample) - 1 as shuffled_no from smp",
    ),
)
def a06(spark, sf):
    return P.shuffle_samples(_sample_numbers(spark, sf), PACK, "first_range").select("dataset", "sample", "shuffled_no")


@query(
    "u02_concat_ranges",
    _ctes(
        "lens",
        f"{_PLAN}, {_SAMPLES}",
        "select dataset, case when separate and sample >= before_last then 'last' else 'first' end as part, count(*) as n, min(sample) as lowest,"
        " max(sample) as highest from smp group by all",
    ),
)
def u02(spark, sf):
    numbers = _sample_numbers(spark, sf)
    first = numbers.where(F.col("sample") < F.col("first_range")).withColumn("part", F.lit("first"))
    last = numbers.where(F.col("sample") >= F.col("first_range")).withColumn("part", F.lit("last"))
    return first.unionByName(last).groupBy("dataset", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("sample").alias("lowest"), F.max("sample").alias("highest")
    )


@query(
    "o04_permutation",
    "select doc_id, row_number() over (order by " + _hash("'7docs:' || doc_id") + ", doc_id) - 1 as place from documents",
)
def o04(spark, sf):
    return O.hash_rank(X.documents(spark, sf).select("doc_id"), 7, ["doc_id"], "place", salt="docs")


@query(
    "w01_running_sum",
    X.with_views(
        "lens",
        "select doc_id, coalesce(sum(n_tokens) over (order by doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as start,"
        " (sum(n_tokens) over ())::bigint as total from lens",
    ),
)
def w01(spark, sf):
    narrow = X.lengths(spark, sf).select("doc_id", "n_tokens")
    return O.prefix_sums(narrow, "doc_id", {"start": F.col("n_tokens")}, totals={"total": "start"}).drop("n_tokens")


# Keys that fill no interval: texts, signed 64-bit integers, and a composite within datasets.
@query(
    "w01_wide_keys",
    X.with_views(
        "lens",
        "select doc_id, coalesce(sum(n_tokens) over (order by md5(doc_id::varchar) rows between unbounded preceding and 1 preceding), 0)::bigint as by_text,"
        " coalesce(sum(n_tokens) over (order by " + _hash("'7:' || doc_id") + " rows between unbounded preceding and 1 preceding), 0)::bigint as by_number,"
        " row_number() over (partition by dataset order by n_tokens, doc_id) - 1 as by_size from lens",
    ),
)
def w01_wide(spark, sf):
    n = {"by_text": F.col("n_tokens")}
    rows = X.lengths(spark, sf).select("doc_id", "dataset", "n_tokens", F.md5(F.col("doc_id").cast("string")).alias("text_key"))
    rows = O.prefix_sums(rows, "text_key", n).withColumn("number_key", (hash_bits(7, F.col("doc_id")) - (1 << 59)) * 16)
    rows = O.prefix_sums(rows, "number_key", {"by_number": F.col("n_tokens")})
    rows = O.dense_index(rows.withColumn("size_key", F.struct("n_tokens", "doc_id")), "size_key", "by_size", ["dataset"])
    return rows.select("doc_id", "by_text", "by_number", "by_size")


# What a dataset's configuration determines, for two sample lengths and a demand of 700 samples.
@query(
    "x04_sample_plan",
    X.with_views(
        "lens",
        "select dataset, l as sequence_length, tokens_per_epoch, epochs, (epochs * tokens_per_epoch - 1) // l as n_samples,"
        " case when epochs > 1 then ((epochs - 1) * tokens_per_epoch - 1) // l else 0 end as samples_before_last from (select *,"
        " greatest((700 * l + 1 + tokens_per_epoch - 1) // tokens_per_epoch, 1) as epochs from (select dataset, sum(n_tokens)::bigint as tokens_per_epoch from lens group by dataset),"
        " (select unnest([64, 128]) as l))",
    ),
)
def x04(spark, sf):
    parts = []
    for length in (64, 128):
        cfg = P.PackConfig(length)
        plan = P.epoch_plan(P.tokens_per_epoch(X.lengths(spark, sf), cfg), cfg, 700)
        parts.append(plan.select("dataset", F.lit(length).alias("sequence_length"), "tokens_per_epoch", "epochs", "n_samples", F.col("samples_before_last").cast("bigint")))
    return parts[0].unionByName(parts[1])


@query("o01_file_order", X.with_views("names", "select file, file_no from names"))
def o01(spark, sf):
    return X.names(spark, sf).orderBy("file", "file_no").select("file", "file_no")


# ---- splits ----------------------------------------------------------------------------------


def _bounds_sql(bounds, total: str) -> str:
    rows = [
        f"select dataset, '{n}' as split, round_even({b[0]!r}::double * {total}, 0)::bigint as \"begin\","
        f" round_even({b[1]!r}::double * {total}, 0)::bigint as \"end\" from c"
        for n, b in zip(SP.SPLITS, bounds)
        if b
    ]
    return " union all ".join(rows)


_COUNTS = "c as (select dataset, count(*) as n from lens group by dataset)"


@query(
    "a08_split_bounds",
    _ctes(
        "lens",
        _COUNTS,
        "select * from (" + _bounds_sql([(0.0, 0.96), (0.96, 0.99), (0.99, 1.0)], "n") + ") union all select dataset, 'overlap_' || split,"
        ' "begin", "end" from (' + _bounds_sql([(0.0, 0.96), (0.98, 0.99), None], "n") + ")",
    ),
)
def a08(spark, sf):
    counts = X.lengths(spark, sf).groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"))
    plain = SP.split_ranges(counts, SP.split_bounds(SPLIT))
    overlap = SP.split_ranges(counts, SP.split_bounds(SPLIT, "98,2,0")).withColumn("split", F.concat(F.lit("overlap_"), "split"))
    return plain.unionByName(overlap).select("dataset", "split", "begin", "end")


_ASSIGNED = (
    "case when r < round_even(0.7::double * n, 0) then 'train' when r < round_even(0.9::double * n, 0) then 'valid'"
    " when r < round_even(0.9::double * n + 0, 0) then null else 'test' end"
)


@query(
    "a09_assign_split",
    X.with_views(
        "lens",
        f"select dataset, doc_id, {_ASSIGNED} as split from (select *, row_number() over (partition by dataset order by doc_id) - 1 as r,"
        " count(*) over (partition by dataset) as n from lens)",
    ),
)
def a09(spark, sf):
    split = SP.assign_split(X.lengths(spark, sf), SP.split_bounds("70,20,10"), "doc_id", ["dataset"])
    return split.select("dataset", "doc_id", "split")


@query(
    "a09_split_by_sequence",
    X.with_views(
        "linew",
        f"select dataset, doc_id, seq_no, {_ASSIGNED} as split from (select dataset, doc_id, i::integer as seq_no, row_number() over (partition by dataset"
        " order by doc_id, i) - 1 as r, count(*) over (partition by dataset) as n from linew)",
    ),
)
def a09_sequence(spark, sf):
    rows = X.line_seqs(spark, sf).drop("tokens")
    split = SP.assign_split(rows, SP.split_bounds("70,20,10"), "doc_id", ["dataset"], ties=["seq_no"])
    return split.select("dataset", "doc_id", "seq_no", "split")


@query(
    "a09_split_by_document",
    X.with_views(
        "linew",
        f"select dataset, doc_id, i::integer as line_no, {_ASSIGNED} as split from (select dataset, doc_id, i from linew) join (select *, row_number() over (partition by dataset"
        " order by doc_id) - 1 as r, count(*) over (partition by dataset) as n from (select distinct dataset, doc_id from linew)) using (dataset, doc_id)",
    ),
)
def a09_doc(spark, sf):
    lines = X.documents(spark, sf).select(
        "doc_id", F.col("source").alias("dataset"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    split = SP.assign_split(lines.drop("line"), SP.split_bounds("70,20,10"), "line_no", ["dataset"], by="document")
    return split.select("dataset", "doc_id", "line_no", "split")


# ---- blends ----------------------------------------------------------------------------------

_W = "w as (select dataset, (row_number() over (order by dataset) - 1)::integer as d, sum(n_tokens)::bigint as weight from lens group by dataset)"
_SHARE = "sh as (select *, weight::double / (sum(weight) over ())::double as share from w)"


def _blend(spark, sf) -> B.Blend:
    return B.collect_blend(P.tokens_per_epoch(X.lengths(spark, sf), PACK), weight="tokens_per_epoch")


def _size(spark, sf) -> int:
    """As many samples as one pass over all datasets yields."""
    return sum(w // L for w in _blend(spark, sf).weights)


@query(
    "a11_blend_requests",
    _ctes(
        "lens",
        f"{_W}, {_SHARE}",
        "select d as dataset_id, dataset, t.split, ceil(t.target * share * 1.005::double)::bigint as requested from sh, (values ('train', 5000), ('valid', 251),"
        " ('test', 10)) as t(split, target)",
    ),
)
def a11(spark, sf):
    totals = P.tokens_per_epoch(X.lengths(spark, sf), PACK)
    entries = B.blend_entries(_blend_list(totals, F.col("tokens_per_epoch").cast("string")))
    return B.entry_requests(entries, {"train": 5000, "valid": 251, "test": 10})


def _blend_list(totals, weight):
    """One blend list ``weight prefix weight prefix ...`` over a table of datasets, in name order."""
    listed = F.sort_array(F.collect_list(F.struct("dataset", weight.alias("weight"))))
    return totals.agg(F.flatten(F.transform(listed, lambda e: F.array(e["weight"], e["dataset"]))).alias("blend"))


_LISTS = (
    "named as (select dataset, d, (weight::varchar || '.25')::double as weight, count(*) over () as n from w),"
    " listed as (select 'all' as split, d as dataset_id, dataset, weight, false as single from named union all"
    " select 'first twice', d, dataset, weight, false from named union all select 'first twice', n, dataset, weight, false from named where d = 0 union all"
    " select 'one', 0, dataset, 1.0::double, true from named where d = 0)"
)


# Three blends as text: all datasets, all and the first once more, and one prefix without a weight.
@query(
    "a11_parse_blend",
    _ctes(
        "lens",
        f"{_W}, {_LISTS}",
        "select split, dataset_id::integer as dataset_id, dataset, weight, round(weight / (sum(weight) over (partition by split)), 9) as share, single from listed",
    ),
)
def a11_parse(spark, sf):
    totals = P.tokens_per_epoch(X.lengths(spark, sf), PACK)
    whole = _blend_list(totals, F.concat(F.col("tokens_per_epoch").cast("string"), F.lit(".25"))).select(F.array_join("blend", " ").alias("text"))
    parts = F.split("text", " ")
    twice = F.concat_ws(" ", "text", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)), F.lit(""))
    blends = whole.select(
        F.explode(F.array(*[F.struct(F.lit(n).alias("split"), t.alias("blend")) for n, t in (("all", F.col("text")), ("first twice", twice), ("one", F.get(parts, F.lit(1))))])).alias("b")
    ).select("b.*")
    return B.blend_entries(blends, by=["split"]).withColumn("share", F.round("share", 9))


_BALANCED = (
    f"size as (select sum(weight // {L})::bigint as size from w), total as (select sum(weight)::bigint as total from w),"
    " draws as (select d, weight, unnest(range(0, size * weight // total + 2)) as k from w, size, total),"
    " ranked as (select d, k, row_number() over (order by (2 * k + 1)::double / weight, d) - 1 as n from draws)"
)


@query(
    "a12_blend_balanced",
    _ctes(
        "lens",
        f"{_W}, {_BALANCED}",
        "select n as sample_idx, d::smallint as dataset_id, k as dataset_sample_idx from ranked, size where n < size.size",
    ),
)
def a12_balanced(spark, sf):
    return B.blend_schedule(spark, _blend(spark, sf), _size(spark, sf))


# Weights are real numbers with twelve decimals, so their exact ratios take wide integers.
@query(
    "a12_fractional_weights",
    _ctes(
        "lens",
        f"{_W}, size as (select sum(weight // {L})::bigint as size from w),"
        " w2 as (select d, weight::hugeint * 1000000000000 + (weight * 7919) % 999999999989 as w from w), total as (select sum(w)::hugeint as total from w2),"
        " draws as (select d, w, unnest(range(0, (size * w // total + 2)::bigint))::hugeint as k from w2, size, total),"
        " placed as (select a.d, a.k, a.k + sum(case when o.d = a.d then 0 else (((2 * a.k + 1) * o.w - (o.d > a.d)::integer) // a.w + 1) // 2 end) as n"
        " from draws a, w2 o group by a.d, a.k)",
        "select n::bigint as sample_idx, d::smallint as dataset_id, k::bigint as dataset_sample_idx from placed, size where n < size.size",
    ),
)
def a12_fractional(spark, sf):
    whole = _blend(spark, sf)
    listed = [x for w, name in zip(whole.weights, whole.names) for x in (f"{w}.{w * 7919 % 999999999989:012d}", name)]
    return B.balanced_schedule(spark, B.parse_blend(listed), _size(spark, sf))


_EXACT = (
    "with recursive {ctes}, fixed as (select list(share order by d) as s, sum(weight // 128)::bigint as size from sh),"
    " steps(n, d, c) as (select 0::bigint, list_position(s, list_max(s)), list_transform(s, lambda x, i: case when i ="
    " list_position(s, list_max(s)) then 1.0::double else 0.0::double end) from fixed"
    " union all select n + 1, pick, list_transform(c, lambda x, i: case when i = pick then x + 1 else x end) from (select n, c, size,"
    " list_position(e, list_max(e)) as pick from (select n, c, size, list_transform(s, lambda x, i: x * (n + 1)::double - c[i]) as e"
    " from steps, fixed where n + 1 < size))),"
    " sched as (select n as sample_idx, (d - 1)::smallint as dataset_id, (c[d] - 1)::bigint as dataset_sample_idx from steps)"
)


def _exact_sql(body: str) -> str:
    head = X.with_views("lens", "select 1").removesuffix("select 1").strip().removeprefix("with ")
    return _EXACT.replace("{ctes}", f"{head}, {_W}, {_SHARE}") + " " + body


@query("a12_blend_exact", _exact_sql("select * from sched"))
def a12_exact(spark, sf):
    return B.exact_schedule(spark, _blend(spark, sf), _size(spark, sf), chunk=500)


@query(
    "g06_achieved_ratios",
    _exact_sql(
        "select sh.d as dataset_id, sh.dataset, round(sh.share, 9) as share, count(sched.sample_idx) as n, round(count(sched.sample_idx) /"
        " max(fixed.size)::double, 9) as achieved from fixed, sh left join sched on sched.dataset_id = sh.d group by all"
    ).replace("from fixed, sh left join sched on sched.dataset_id = sh.d", "from sh cross join fixed left join sched on sched.dataset_id = sh.d"),
)
def g06(spark, sf):
    blend, size = _blend(spark, sf), _size(spark, sf)
    ratios = B.achieved_ratios(B.exact_schedule(spark, blend, size, chunk=500), blend, size)
    return ratios.withColumns({"share": F.round("share", 9), "achieved": F.round("achieved", 9)})


# The whole schedule: one pass over all datasets. A draw past the last sample of its dataset has none and is left out.
@query(
    "j07_blended_lookup",
    _ctes(
        "flat lens",
        f"{_W}, {_BALANCED}, packed as ({PACKED.format(L=L)})",
        "select r.n as sample_idx, r.d::smallint as dataset_id, r.k as dataset_sample_idx, p.tokens from ranked r join size on r.n < size.size"
        " join w using (d) join packed p on p.dataset = w.dataset and p.sample = r.k",
    ),
)
def j07(spark, sf):
    blend = _blend(spark, sf)
    ids = B.blend_frame(spark, blend).select("dataset_id", "dataset")
    packed = P.pack_samples(X.seqs(spark, sf), PACK).join(F.broadcast(ids), "dataset")
    schedule = B.blend_schedule(spark, blend, _size(spark, sf))
    hit = B.lookup_blended(schedule, packed.select("dataset_id", "sample", "tokens"), missing="skip")
    return hit.select("sample_idx", "dataset_id", "dataset_sample_idx", X.joined("tokens").alias("tokens"))


# ---- sentence mapping ------------------------------------------------------------------------


def _fold(eligible: str, target: str, least: int, remaining: int, epochs: int) -> str:
    """Spans of all documents, one sentence of each per recursion step."""
    close = (
        f"((len + sizes[i + 1] >= target and n_sent - (i + 1) >= {remaining} and i + 1 - first >= {least}) or i + 1 = n_sent)"
    )
    return (
        "with recursive {ctes}, docs as (select *, row_number() over (order by doc_id) - 1 as doc, (sum(n_sent) over (order by doc_id) - n_sent)::bigint as base"
        f" from sizes), start as (select doc_id, epoch from docs, unnest(range(0, {epochs})) as e(epoch) where {eligible}),"
        " rec(doc_id, epoch, i, first, len, cut, s, e, t) as (select doc_id, epoch, 0, 0, 0::bigint, 0, null::integer, null::integer, null::bigint from start"
        " union all select doc_id, epoch, i + 1, case when close then i + 1 else first end, case when close then 0 else len + size end,"
        " cut + close::integer, case when close then first end, case when close then i + 1 end, target from (select *, "
        f"{close} as close, sizes[i + 1] as size from (select rec.*, docs.sizes, docs.n_sent, {target} as target from rec join docs using (doc_id)"
        " where rec.i < docs.n_sent))),"
        " spans as (select rec.doc_id, epoch, s, e, t, cut - 1 as cut_no, docs.base, docs.doc from rec join docs using (doc_id) where s is not null),"
        " before as (select a.epoch, coalesce(sum(b.n), 0) as rows_before from (select distinct epoch from start) a left join"
        " (select epoch, count(*) as n from spans group by epoch) b on b.epoch < a.epoch group by a.epoch),"
        " numbered as (select spans.*, row_number() over (order by epoch, doc_id, cut_no) - 1 as map_index, row_number() over (partition by epoch"
        " order by doc_id, cut_no) - 1 as block_id, rows_before from spans join before using (epoch)) {body}"
    )


def _map_sql(eligible, target, least, remaining, epochs, body) -> str:
    head = X.with_views("sizes", "select 1").removesuffix("select 1").strip().removeprefix("with ")
    return _fold(eligible, target, least, remaining, epochs).replace("{ctes}", head).replace("{body}", body)


_PAIR_BODY = 'select map_index, base + s as start, base + e as "end", t::integer as target from numbered where rows_before < 2000'
_PAIRS_OK = "n_sent >= 2 and longest <= 512"


@query("a15_sentence_pairs", _map_sql(_PAIRS_OK, "100::bigint", 2, 2, 3, _PAIR_BODY))
def a15(spark, sf):
    return MP.map_sentences(X.sizes(spark, sf), 100, epochs=3, max_samples=2000)


@query("a15_all_epochs", _map_sql(_PAIRS_OK, "100::bigint", 2, 2, 3, _PAIR_BODY.replace("2000", "1000000000")))
def a15_all(spark, sf):
    return MP.map_sentences(X.sizes(spark, sf), 100, epochs=3)


_SHORT = "(case when {h} % 4 = 0 then 2 + {h} % 99 else 100 end)".format(h=_hash("'1234:' || rec.epoch || ':' || rec.doc_id || ':' || rec.cut"))


@query("a15_short_targets", _map_sql(_PAIRS_OK, _SHORT, 2, 2, 2, _PAIR_BODY.replace("2000", "1000000000")))
def a15_short(spark, sf):
    return MP.map_sentences(X.sizes(spark, sf), 100, epochs=2, short_ratio=4)


_BLOCK_BODY = 'select map_index, base + s as start, base + e as "end", doc, block_id from numbered'


def _titled(spark, sf):
    return X.sizes(spark, sf).withColumn("title_size", F.coalesce(F.get("sizes", F.lit(0)), F.lit(0)))


@query("a16_blocks", _map_sql("n_sent >= 2 and longest <= 512", "(128 - docs.sizes[1])::bigint", 2, 2, 2, _BLOCK_BODY))
def a16(spark, sf):
    return MP.map_blocks(_titled(spark, sf), 128, epochs=2)


@query("a16_one_sentence_blocks", _map_sql("n_sent >= 1 and longest <= 512", "(128 - docs.sizes[1])::bigint", 1, 1, 1, _BLOCK_BODY))
def a16_one(spark, sf):
    return MP.map_blocks(_titled(spark, sf), 128, one_sentence_blocks=True)


@query(
    "a17_shuffle_mapping",
    _map_sql(
        _PAIRS_OK, "100::bigint", 2, 2, 1,
        "select map_index, base + s as start, row_number() over (order by " + _hash("'99map:' || map_index") + ", map_index) - 1 as shuffled_no from numbered",
    ),
)
def a17(spark, sf):
    mapped = MP.map_sentences(X.sizes(spark, sf), 100)
    return MP.shuffle_mapping(mapped, 99).select("map_index", "start", "shuffled_no")


# ---- mixtures --------------------------------------------------------------------------------


@query("u03_distinct_paths", X.with_views("mix", "select rounds, path from mix"))
def u03(spark, sf):
    rounds, _ = X.mix(spark, sf)
    return rounds.dropDuplicates()


_WEIGHTS = "we as (select rounds, path[1:length(path) - 4] as path, trunc(n_tokens * rounds)::bigint::varchar as weight from mix)"


@query("f31_mixture_weights", _ctes("mix", _WEIGHTS, "select string_agg(weight || ' ' || path || ' ', '' order by rounds, path) as mixture from we"))
def f31(spark, sf):
    found, _ = MX.mixture_table(*X.mix(spark, sf))
    return MX.mixture_string(MX.mixture_weights(found))


@query(
    "f31b_repeated_weights",
    X.with_views(
        "mix",
        "select rounds, path[1:length(path) - 4] as path, unnest(range(1, greatest(rounds::integer, 1) + 1))::integer as copy_no,"
        " case when rounds >= 1 then '1' else rounds::varchar end as weight from (select path, rounds from mix)",
    ).replace("greatest(rounds::integer, 1)", "greatest(trunc(rounds)::integer, 1)"),
)
def f31b(spark, sf):
    found, _ = MX.mixture_table(*X.mix(spark, sf))
    return MX.mixture_weights(found, "repeat")


@query(
    "g07_mixture_totals",
    X.with_views(
        "mix",
        "select sum(n_tokens * rounds) as total_tokens, format('{:.3f}B', sum(n_tokens * rounds) / 1e9) as total_billions,"
        " round(sum(n_tokens * rounds) / 4096.0::double, 9) as train_iters from mix",
    ),
)
def g07(spark, sf):
    found, _ = MX.mixture_table(*X.mix(spark, sf))
    return MX.mixture_totals(found, 8, 512).withColumn("train_iters", F.round("train_iters", 9))


@query(
    "f33_plan_iterations",
    X.with_views(
        "counts",
        "select path, trunc(n_tokens / 512.0::double)::bigint as train_iters, (trunc(n_tokens / 512.0::double)::bigint // 10 + 1) * 3 as eval_iters,"
        " 3::bigint as test_iters, trunc(n_tokens / 512.0::double)::bigint * 4 as train_samples, (trunc(n_tokens / 512.0::double)::bigint // 10 + 1) * 12"
        " as valid_samples, 12::bigint as test_samples from counts",
    ),
)
def f33(spark, sf):
    _, counts = X.mix(spark, sf)
    return counts.select("path", *[c.alias(n) for n, c in MX.plan_iterations(F.col("n_tokens"), 4, 128, 10, 3).items()])
