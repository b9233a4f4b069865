"""The registered queries of this subpackage: thin applications of its operators to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtrace.llm import chat, line_dedup, minhash, mixing, neighbours, packing, prefix_trie, quality_classifier, quality_rules, storage, suffix_arrays, token_counts, token_files, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row is one message of its conversation, logged in the order of turns as two streamed deltas. Those of assistants
    are drafts first: an edit replaces every second of them, a regeneration the others with what followed them."""
    rows = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) as conv_id", "cast(turn as long) as turn", "role", "text")
    own = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    numbered = rows.unionByName(own).selectExpr("conv_id", "row_number() over (partition by conv_id order by turn, role, text) as message", "role", "text", "cast(char_length(text) / 2 as int) as half")
    event = "struct({} as kind, {} as message, {} as role, {} as text)".format
    head, tail, draft = "substring(text, 1, half)", event("'delta'", "message", "role", "substring(text, half + 1)"), event("'delta'", "message", "role", "'a draft'")
    regenerated = f"array({draft}, {event(repr('delta'), 'message + 1', repr('user'), repr('on the draft'))}, {event(repr('regenerate'), 'message', 'role', head)}, {tail})"
    edited = f"array({draft}, {event(repr('edit'), 'message', 'role', head)}, {tail})"
    streamed = f"array({event(repr('delta'), 'message', 'role', head)}, {tail})"
    events = numbered.selectExpr("conv_id", "message as place", f"posexplode(case when role = 'assistant' and message % 4 = 0 then {regenerated} when role = 'assistant' then {edited} else {streamed} end) as (nth, event)")
    back = chat.read_back(chat.formatted(chat.messages(events.selectExpr("conv_id", "4 * place + nth as seq", "event.*"))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = storage.new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_files(spark, out)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=4096)
    return packing.pack(pieces, 4096)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_groups(table(spark, sf_dir, "documents"), least_exact=1).select("doc_id", "line", "class_doc", "class_line", "kept")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.in_training_order(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round("first_position", 6).alias("first_position"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))  # a row without an id has no remainder
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    found = quality_classifier.score(docs, model, threshold=0.3)
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def rebuilt(strings: DataFrame) -> DataFrame:
    """Conversations of ``prefix_trie.turn_strings`` that begin with the first turns of the first of their five: up to eight of them."""
    heads = strings.selectExpr("conv_id as base", "slice(turns, 1, 8) as head")
    own = strings.selectExpr("conv_id", "turns", "conv_id - conv_id % 5 as base", "cast(crc32(cast(conv_id as string)) % 9 as int) as h")
    return own.join(heads, "base", "left").selectExpr("conv_id", "concat(slice(coalesce(head, filter(turns, t -> false)), 1, h), slice(turns, h + 1, size(turns))) as turns")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(rebuilt(prefix_trie.turn_strings(table(spark, sf_dir, "conversations"))))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, model = whitening.whiten(table(spark, sf_dir, "embeddings"), k=16)
    n, error = (model.n, model.error) if model else (0, 0.0)
    shares = [float(v / model.trace) for v in model.values] if model else []
    explained = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    rows = found.select("vec_id", "deviation", F.posexplode("whitened").alias("nth", "whitened"))
    return rows.select("vec_id", (F.col("nth") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("nth")).alias("explained"), F.lit(error).alias("identity_error"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_arrays.repeats(table(spark, sf_dir, "documents"), length=200)
    removed = F.expr("aggregate(spans, 0L, (t, s) -> t + s.end - s.start)")
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


OP1_SQL = r"""
with c as (select conv_id, turn, role, text from conversations
    union all select -7, 0, 'user', '\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n from c),
e as (select *, length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t')) as body,
        length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c')) as head from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(head + body + 14)::bigint as formatted_chars
from e group by conv_id
"""

OP8_SQL = r"""
with sized as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
        md5('7:' || coalesce(doc_id::varchar, 'null')) as key, md5(coalesce(text, '')) as tie from documents),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
ranked as (select *, row_number() over (order by source asc nulls last) - 1 as nth from totals),
level as (select *, [5.0::double, 2.0::double, 1.0::double][(nth % 3 + 1)::int] as weight, nth % 3 as shape, 3.0::double * source_size as stop from ranked),
ratios as (select *, stop / weight as ratio from level),
run as (select *, (sum(source_size) over ())::double as everything,
        coalesce(sum(stop) over (order by ratio, source asc nulls last rows between unbounded preceding and 1 preceding), 0) as stopped,
        sum(weight) over () - coalesce(sum(weight) over (order by ratio, source asc nulls last rows between unbounded preceding and 1 preceding), 0) as open from ratios),
water as (select *, max(case when (everything - stopped) / open <= ratio then (everything - stopped) / open end) over () as w from run),
targets as (select source, source_size, shape, least(stop, coalesce(w * weight, stop)) as target from water),
placed as (select s.doc_id, s.size, t.source_size, t.target, t.shape,
        coalesce(sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.tie rows between unbounded preceding and 1 preceding), 0)::bigint as place
    from sized s join targets t on s.source is not distinct from t.source),
uses as (select *, least(size, greatest(floor(target)::bigint - place, 0)) as u0, least(size, greatest(floor(target)::bigint - (source_size + place), 0)) as u1,
        least(size, greatest(floor(target)::bigint - (2 * source_size + place), 0)) as u2, place / target as share from placed),
segments(shape, t0, t1, w0, w1) as (values (0, 0.0, 0.5, 3.0, 1.5), (0, 0.5, 1.0, 1.5, 0.5), (1, 0.0, 1.0, 1.0, 1.0), (2, 0.0, 0.75, 0.25, 1.0), (2, 0.75, 1.0, 1.0, 4.0)),
areas as (select shape, t0::double t0, t1::double t1, w0::double w0, w1::double w1, (t1::double - t0::double) * (w0::double + w1::double) / 2 as area from segments),
demand as (select *, coalesce(sum(area) over (partition by shape order by t0 rows between unbounded preceding and 1 preceding), 0) / sum(area) over (partition by shape) as d0,
        sum(area) over (partition by shape order by t0) / sum(area) over (partition by shape) as d1 from areas),
solved as (select u.*, d.*, (share - d0) / (d1 - d0) as y from uses u left join demand d on u.shape = d.shape and u.u0 > 0 and u.share >= d.d0 and u.share < d.d1)
select doc_id, size, source_size, target, (u0 + u1 + u2)::bigint as taken,
    round(t0 + (t1 - t0) * (case when w0 = w1 then y else (sqrt(w0 * w0 + (w1 - w0) * (w0 + w1) * y) - w0) / (w1 - w0) end), 6) as first_position
from solved
"""

OP11_SQL = r"""
with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as n from conversations where conv_id is not null),
own as (select conv_id, list(md5(strlen(role)::varchar || ':' || role || text) order by n) as digests, list(strlen(text) order by n) as sizes from t group by 1),
keyed as (select *, (xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint)),
        lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)), 4294967295::bigint) % 9)::int as h from own),
rebuilt as (select k.conv_id, list_concat(list_slice(coalesce(b.digests, []), 1, k.h), list_slice(k.digests, k.h + 1, len(k.digests))) as digests, list_concat(list_slice(coalesce(b.sizes, []), 1, k.h), list_slice(k.sizes, k.h + 1, len(k.sizes))) as sizes
    from keyed k left join own b on b.conv_id = k.conv_id - k.conv_id % 5),
depths as (select conv_id, digests, sizes, unnest(range(len(digests) + 1)) as d from rebuilt),
prefixes as (select conv_id, d, d = len(digests) as last, md5(d::varchar || array_to_string(list_slice(digests, 1, d), ',')) as key, case when d > 0 then md5((d - 1)::varchar || array_to_string(list_slice(digests, 1, d - 1), ',')) end as above,
        case when d > 0 then sizes[d] else 0 end as b from depths),
nodes as (select key, any_value(above) as above, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n, any_value(b) as b, coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where last), '') as ends from prefixes group by key),
kids as (select above, count(*) as n_children from nodes where above is not null group by 1),
full_nodes as (select n.*, p.conv_id as parent_conv_id, coalesce(k.n_children, 0) as n_children from nodes n left join nodes p on p.key = n.above left join kids k on k.above = n.key),
sums as (select p.key, sum((u.n - 1) * u.b)::bigint as saved_tokens, count(*) filter (where u.n_children = 0) as n_leaves from full_nodes u join prefixes p on p.conv_id = u.conv_id and p.d <= u.depth group by 1)
select conv_id, depth, parent_conv_id, n as n_convs, n_children, n_leaves, saved_tokens, sha256(ends) as ends_sha256 from full_nodes join sums using (key)
"""

QUERIES = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_token_files": op2_token_files,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_mixing": op8_mixing,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_whitening": op12_whitening,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
}
ORACLES = {"op1_chat_formatting": OP1_SQL, "op8_mixing": OP8_SQL, "op11_prefix_trie": OP11_SQL}
