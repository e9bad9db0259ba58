"""Queries of this subpackage's operators over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablevault.llm import (conversation_trie, decontaminate, embedding_dedup, language_id, mixing, near_dedup, periodic_runs,
                            quality_rules, suffix_dedup, token_count, token_output, url_filter, warc)
from tablevault.llm.common import words_of
from tablevault.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 2048
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


def tokenizer_file() -> str:
    """The word tokenizer's file, from the package that is installed everywhere."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf, "documents"))


def op2_token_output(spark: SparkSession, sf: str) -> DataFrame:
    return token_output.tokens_written_and_read(table(spark, sf, "documents"), tokenizer_file())


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = language_id.held_out("doc_id")
    model = language_id.fit(docs.where(~out))
    return language_id.predict(docs, model, carry=(out.alias("held_out"),)).select(
        "doc_id", "held_out", "lang_pred", "score")


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf, "documents"))


def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf, "pages"), URL_RULES, model)


def op6_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf, "documents"), tokenizer_file()).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.written_and_read(table(spark, sf, "pages"))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.placed(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_mixing_positions(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.placed(table(spark, sf, "documents")).select("doc_id", F.posexplode("positions").alias("pass", "position")).select(
        "doc_id", F.col("pass").cast("long").alias("pass"), "position")


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op11_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    turns = conversation_trie.shared_openings(conversation_trie.turn_ids(table(spark, sf, "conversations")))
    return conversation_trie.trie(*turns)


def planted_repeats(docs: DataFrame) -> DataFrame:
    """Every tenth text by the checksum of its id goes over into repeats of a stretch of itself."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g, words = F.expr("h div 10"), F.col("words")
    n = F.size("words")
    a = F.expr("(h div 10) % size(words)")
    docs = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when((F.col("h") % 10 == 0), words_of(F.col("text"))))
    docs = docs.withColumn("a", F.when(n > 0, a)).withColumn(
        "p", F.when(n > 0, F.floor((n - F.col("a")) / (g % 8 + 3)) + 1))
    repeats = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(
        words, (F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i) + 1).cast("int")))
    return docs.select("doc_id", F.when(F.col("p").isNotNull(), F.array_join(repeats, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    found = periodic_runs.find_runs(planted_repeats(table(spark, sf, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(best["length"] * 1000 / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(periodic_runs.runs_text(F.col("runs")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_token_output": op2_token_output,
    "op3_language_id": op3_language_id,
    "op4_quality_rules": op4_quality_rules,
    "op5_url_filter": op5_url_filter,
    "op6_decontaminate": op6_decontaminate,
    "op7_token_counts": op7_token_counts,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op9_mixing_positions": op9_mixing_positions,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

# crc32 of a text of digits as a DuckDB expression: needs ``crc_table`` (one list ``t``) in scope.
CRC_TABLE = """crc_table as (select list(v order by i) as t from (select i, list_reduce(list_prepend(i::bigint, range(8)),
               lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(i)))"""


def crc_sql(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::bigint)), "
            "lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8)), 4294967295)")


ORACLE: dict[str, str] = {
    "op1_near_dedup": r"""
        with recursive w as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x20\x09-\x0D]+') as l from documents),
        s as (select doc_id, list_distinct(case when len(l) = 0 then [] when len(l) < 5 then [array_to_string(l, ' ')]
                     else list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' ')) end) as g from w),
        n as (select doc_id, len(g)::bigint as n from s),
        u as (select doc_id, unnest(g) as g from s),
        c as (select a.doc_id as a, b.doc_id as b, count(*) as k from u a join u b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
        e as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
        r as (select doc_id as a, doc_id as b from documents union select r.a, e.b from r join e on e.a = r.b),
        m as (select a as doc_id, min(b) as component_id from r group by 1),
        k as (select min(doc_id) as class_id, g from (select doc_id, list_sort(g) as g from s where len(g) > 0) group by g)
        select n.doc_id, n.n as n_shingles, coalesce(k.class_id, n.doc_id) as class_id, m.component_id,
               n.doc_id = m.component_id as kept
        from n join m on m.doc_id = n.doc_id join s on s.doc_id = n.doc_id left join k on k.g = list_sort(s.g)""",
    "op6_decontaminate": r"""
        with d as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as l from documents),
        b as (
          select coalesce(item_id::varchar, '') as item,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as l from benchmark),
        q as (select distinct item, size, array_to_string(l[i:i + size - 1], ' ') as k
              from (select item, l, least(len(l), 10) as size, unnest(range(1, greatest(len(l) - 9, 1) + 1)) as i from b where len(l) > 0)),
        z as (select distinct size from q),
        p as (select doc_id, size, i, array_to_string(l[i:i + size - 1], ' ') as k
              from (select doc_id, l, size, unnest(range(1, len(l) - size + 2)) as i from d, z)),
        h as (select doc_id, i, p.size, item from p join q on q.size = p.size and q.k = p.k),
        c as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + size)) as j from h) group by 1),
        t as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from h) group by 1)
        select d.doc_id, len(l)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(t.n, 0)::bigint as n_items,
               sha256(coalesce(t.items, '')) as items_sha256, coalesce(c.n, 0) > 0 as contaminated
        from d left join c on c.doc_id = d.doc_id left join t on t.doc_id = d.doc_id""",
    "op10_suffix_dedup": """
        with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, ''))::bigint as n from documents),
        w as (select doc_id, i, md5(substr(h, 2 * i + 1, 200)) as k from (select doc_id, h, unnest(range(0, n - 99)) as i from d)),
        r as (select doc_id, i from (select doc_id, i, row_number() over (partition by k order by doc_id, i) as rn from w) where rn > 1),
        g as (select doc_id, i, sum(new) over (partition by doc_id order by i) as run
              from (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 100 then 0 else 1 end as new from r)),
        s as (select doc_id, min(i) as lo, max(i) + 100 as hi from g group by doc_id, run),
        p as (select doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as start from s),
        a as (select p.doc_id, sum(hi - lo)::bigint as n_removed, count(*) as n_spans, max(hi) as hi,
                     string_agg(substr(h, 2 * start + 1, 2 * (lo - start)), '' order by lo) as kept
              from p join d on d.doc_id = p.doc_id group by p.doc_id)
        select d.doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
               sha256(unhex(case when a.doc_id is null then h else concat(kept, substr(h, 2 * hi + 1)) end)) as kept_sha256
        from d left join a on a.doc_id = d.doc_id""",
    "op8_warc": """
        with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes,
                          sha256(coalesce(html, '')) as payload_digest from pages),
        f as (select *, case when payload_bytes >= 100
                             then min(page_id) over (partition by payload_digest, payload_bytes) end as first from p)
        select page_id, payload_bytes, payload_digest,
               case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
               case when first <> page_id then first end as refers_to from f""",
    "op9_mixing": r"""
        with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
                          md5(doc_id::varchar) as h from documents),
        s as (select source, sum(size)::bigint as source_size from d group by source),
        w as (select *, [3, 1, 2][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from s),
        r as (select *, source_size * 2 as cap, (source_size * 2)::double / weight as ratio from w),
        l as (select *, ((sum(source_size) over ())::double * 1.5
                         - coalesce(sum(cap) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0)::double)
                        / (sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following))::double as lv
              from r),
        f as (select (arg_min(lv, ratio) filter (where lv <= ratio)) as lv from l),
        t as (select l.source, source_size, case when f.lv is null then cap::double else least(cap::double, f.lv * weight) end as target
              from l, f),
        c as (select d.*, t.source_size, t.target,
                     coalesce(sum(size) over (partition by d.source order by h, doc_id, size
                                              rows between unbounded preceding and 1 preceding), 0)::double + size / 2.0 as mid
              from d join t on d.source is not distinct from t.source)
        select doc_id, size, source_size, target,
               (size * ((mid <= target)::int + (mid + source_size <= target)::int))::bigint as taken from c""",
    "op9_mixing_positions": r"""
        with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
                          md5(doc_id::varchar) as h from documents),
        s as (select source, sum(size)::bigint as source_size from d group by source),
        w as (select *, ((row_number() over (order by source nulls last) - 1) % 3)::int as k from s),
        r as (select *, [3, 1, 2][k + 1] as weight, source_size * 2 as cap,
                     (source_size * 2)::double / [3, 1, 2][k + 1] as ratio from w),
        l as (select *, ((sum(source_size) over ())::double * 1.5
                         - coalesce(sum(cap) over (order by ratio, source nulls last rows between unbounded preceding and 1 preceding), 0)::double)
                        / (sum(weight) over (order by ratio, source nulls last rows between current row and unbounded following))::double as lv
              from r),
        f as (select (arg_min(lv, ratio) filter (where lv <= ratio)) as lv from l),
        t as (select l.source, k, source_size, case when f.lv is null then cap::double else least(cap::double, f.lv * weight) end as target
              from l, f),
        c as (select d.*, t.k, t.source_size, t.target,
                     coalesce(sum(size) over (partition by d.source order by h, doc_id, size
                                              rows between unbounded preceding and 1 preceding), 0)::double + size / 2.0 as mid
              from d join t on d.source is not distinct from t.source),
        p as (select doc_id, k, pass, (mid + source_size * pass) / greatest(target, 1e-9::double) as x
              from c, (select unnest([0, 1])::bigint as pass) where mid + source_size * pass <= target),
        -- the pieces of each schedule: start and end in time and weight, area before and inside
        q as (select *, (t1 - t0) * (w0 + w1) / 2 as area, (w1 - w0) / (t1 - t0) as slope
              from (values (0, 0, 0e0, 0.6e0, 1.5e0, 1e0), (0, 1, 0.6e0, 1e0, 1e0, 0.5e0), (1, 0, 0e0, 1e0, 1e0, 1e0),
                           (2, 0, 0e0, 0.4e0, 0.5e0, 1e0), (2, 1, 0.4e0, 1e0, 1e0, 1.5e0)) v(k, piece, t0, t1, w0, w1)),
        z as (select *, coalesce(sum(area) over (partition by k order by piece rows between unbounded preceding and 1 preceding), 0) as done,
                     sum(area) over (partition by k) as total from q),
        y as (select doc_id, pass, piece, t0, w0, slope, greatest(x * total - done, 0e0) as need
              from p join z on z.k = p.k where x * total <= done + area
              qualify row_number() over (partition by doc_id, p.k, pass, x order by piece) = 1)
        select doc_id, pass, least(t0 + case when slope = 0 then need / w0
                                             else (sqrt(greatest(need * 2 * slope + w0 * w0, 0e0)) - w0) / slope end, 1e0) as position
        from y""",
}

ORACLE["op13_periodic_runs"] = rf"""
        with {CRC_TABLE},
        d as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as l, {crc_sql("doc_id::varchar")} as h
              from documents, crc_table),
        x as (select *, len(l) as n, case when h % 10 = 0 and len(l) > 0 then (h // 10) % len(l) end as a from d),
        y as (select *, case when a is not null then 1 + (n - a) // (3 + (h // 10) % 8) end as p from x),
        w as (select doc_id, n, case when p is null then l else
                     list_transform(range(n), lambda i: l[(1 + case when i >= a then a + (i - a) % p else i end)::int]) end as l from y),
        s as (select doc_id, i, array_to_string(l[i + 1:i + 16], ' ') as k
              from (select doc_id, l, unnest(range(0, n - 15)) as i from w)),
        m as (select b.doc_id, b.i, b.i - a.i as lag from s a join s b on a.doc_id = b.doc_id and a.k = b.k and a.i < b.i),
        g as (select *, i - row_number() over (partition by doc_id, lag order by i) as island from m),
        e as (select doc_id, lag, min(i) - lag as start, count(*) + 15 + lag as length from g group by doc_id, lag, island),
        r as (select doc_id, start::bigint as start, length::bigint as length, min(lag)::bigint as period from e
              where length >= greatest(24, 3 * lag) group by doc_id, start, length),
        b as (select *, row_number() over (partition by doc_id order by length::hugeint * 1000000000000 // period desc, start, period) as place
              from r),
        t as (select doc_id, count(*) as n_runs,
                     sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period)) as runs_sha256
              from r group by doc_id),
        o as (select distinct doc_id, unnest(range(start + period, start + length)) as i from r),
        u as (select doc_id, unnest(l) as word, unnest(range(0, n)) as i from w),
        c as (select u.doc_id, sha256(string_agg(word, ' ' order by u.i)) as k from u anti join o on o.doc_id = u.doc_id and o.i = u.i
              group by u.doc_id)
        select w.doc_id, coalesce(n_runs, 0)::bigint as n_runs, b.start, b.length, b.period,
               (1000 * b.length // b.period)::bigint as exponent_milli, coalesce(runs_sha256, sha256('')) as runs_sha256,
               coalesce(c.k, sha256('')) as collapsed_sha256
        from w left join t on t.doc_id = w.doc_id left join b on b.doc_id = w.doc_id and b.place = 1
        left join c on c.doc_id = w.doc_id"""

ORACLE["op12_conversation_trie"] = f"""
        with {CRC_TABLE},
        o as (select conv_id, sha256(concat(len(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) as k,
                     len(coalesce(text, '')) as chars, turn from conversations where conv_id is not null),
        s as (select conv_id, k, chars, row_number() over (partition by conv_id order by turn nulls first, k) as pos from o),
        c as (select conv_id, {crc_sql("conv_id::varchar")} % 6 as h from (select distinct conv_id from s), crc_table),
        b as (select conv_id, k, chars, pos from c join (select conv_id as base, k, chars, pos from s) s
                     on s.base = c.conv_id - c.conv_id % 100 and pos <= h
              union all select conv_id, k, chars, pos from s join c using (conv_id) where pos > h),
        r as (select conv_id, k, chars, row_number() over (partition by conv_id order by pos) as depth from b),
        x as (select conv_id, depth, chars, string_agg(k, '') over (partition by conv_id order by depth) as prefix from r
              union all select conv_id, 0, 0, '' from c),
        n as (select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, max(chars) as chars from x group by depth, prefix),
        p as (select x.conv_id, x.depth, n.conv_id as named from x join n using (depth, prefix)),
        e as (select conv_id, max(depth) as depth from x group by conv_id),
        t as (select named as conv_id, depth, sha256(string_agg(conv_id, ',' order by conv_id)) as ends
              from p join e using (conv_id, depth) group by named, depth),
        u as (select n.conv_id, n.depth, n_convs, chars, a.named as parent_conv_id from n
              left join p a on a.conv_id = n.conv_id and a.depth = n.depth - 1),
        k as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from u where depth > 0 group by 1, 2),
        v as (select u.*, coalesce(n_children, 0) as n_children from u left join k using (conv_id, depth)),
        a as (select p.named as conv_id, p.depth, sum((v.n_children = 0)::int)::bigint as n_leaves,
                     sum((v.n_convs - 1) * v.chars)::bigint as saved_tokens
              from v join p on p.conv_id = v.conv_id and p.depth <= v.depth group by p.named, p.depth)
        select v.conv_id, v.depth::bigint as depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
               coalesce(ends, sha256('')) as ends_sha256
        from v join a using (conv_id, depth) left join t using (conv_id, depth)"""

ORACLE["op11_embedding_dedup"] = """
        with recursive v as (select vec_id, embedding::double[] as e from embeddings
                   where vec_id is not null and len(embedding) > 0 and not list_contains(list_transform(embedding, lambda x: x is null or not isfinite(x)), true)
                         and list_contains(list_transform(embedding, lambda x: x <> 0), true)),
        p as materialized (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
                           where list_cosine_similarity(a.e, b.e) >= 0.9),
        l as (select a as vec_id, count(*) as n from p group by a),
        r as (select vec_id as a, vec_id as b from embeddings union select r.a, p.b from r join p on p.a = r.b),
        m as (select a as vec_id, min(b) as component_id from r group by a),
        k as (select vec_id, min(vec_id) over (partition by e) as class_id from v)
        select x.vec_id, coalesce(l.n, 0)::bigint as n_links, coalesce(class_id, x.vec_id) as class_id, component_id,
               x.vec_id = component_id as kept
        from embeddings x left join l on l.vec_id = x.vec_id left join m on m.vec_id = x.vec_id left join k on k.vec_id = x.vec_id"""


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)