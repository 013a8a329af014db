"""The registered queries of this subpackage and their DuckDB forms."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import collisions, licenses, lines, middle, mixing, multiset, packing, phrases, ppm, records, sharding, simhash

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = [f"shard-{i:02d}" for i in range(64)]


def _docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_packing(spark, sf_dir):
    return packing.pack(_docs(spark, sf_dir), TOKENIZER)


def op2_simhash(spark, sf_dir):
    return simhash.simhash_components(_docs(spark, sf_dir))


def op3_licenses(spark, sf_dir):
    return licenses.license_scan(_docs(spark, sf_dir))


def op4_embeddings(spark, sf_dir):
    return collisions.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_lm_score(spark, sf_dir):
    return ppm.score(_docs(spark, sf_dir))


def op6_sharding(spark, sf_dir):
    return sharding.place(_docs(spark, sf_dir).select("doc_id", "text"), SHARDS).select("doc_id", "slot", "shard")


def op7_records(spark, sf_dir):
    return records.read_digests(spark, records.write_records(_docs(spark, sf_dir), TOKENIZER).collect())


def op8_multiset(spark, sf_dir):
    return multiset.edited_fingerprints(_docs(spark, sf_dir))


def op9_language(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    got = ppm.identify(docs, ppm.fit_languages(docs), ["doc_id"])
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return got.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_mixing(spark, sf_dir):
    return mixing.mix(_docs(spark, sf_dir).select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_collocations(spark, sf_dir):
    return phrases.collocations(_docs(spark, sf_dir))


def op12_line_dedup(spark, sf_dir):
    return lines.drop_common_lines(_docs(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op13_fill_in_middle(spark, sf_dir):
    d = middle.fill_in_middle(_docs(spark, sf_dir))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries():
    return {f.__name__: f for f in (op1_packing, op2_simhash, op3_licenses, op4_embeddings, op5_lm_score, op6_sharding, op7_records, op8_multiset, op9_language, op10_mixing, op11_collocations, op12_line_dedup, op13_fill_in_middle, pipeline)}


_TABLE = ",".join(map(str, sharding.fill_table(SHARDS)))


ORACLE = {
    "op6_sharding": f"""
        select doc_id, slot, 'shard-' || lpad(string_split('{_TABLE}', ',')[slot + 1], 2, '0') as shard
        from (select doc_id, cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), text, '')), 1, 12) as bigint) % 8191 as slot from documents)""",
    "op10_mixing": f"""
        with d as (select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
                     cast('0x' || substr(md5('11|' || coalesce(cast(doc_id as varchar), '') || '|' || coalesce(text, '') || case when j > 1 then '|' || j else '' end), 1, 12) as bigint) / 281474976710656.0::double as u
                   from (select *, row_number() over (partition by doc_id, source, text) as j from documents)),
        s as (select source, cast(sum(size) as bigint) as source_size, count(*) as n_docs,
                     [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from d group by source),
        f as (select *, source_size * 2.0::double as cap, sum(source_size) over () * 1.5::double as total from s),
        g as (select *, (total - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
                     / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level from f),
        h as (select *, case when level * weight <= cap then row_number() over (order by cap / weight, source nulls last) end as fill_rank from g),
        t as (select *, least(cap, coalesce((select arg_min(level, fill_rank) from h where fill_rank is not null), 0) * weight) as target from h),
        j as (select d.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate from d join t on d.source is not distinct from t.source)
        select doc_id, size, source_size, target, size * cast(floor(rate) + case when u < rate - floor(rate) then 1 else 0 end as bigint) as taken from j""",
    "op11_collocations": """
        with p as (
            select lang, piece_no, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from (
                select coalesce(lang, 'und') as lang, row_number() over () as piece_no, piece from (
                    select lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents))),
        t as (select lang, piece_no, unnest(w) as w1, generate_subscripts(w, 1) as i from p),
        u as (select lang, w1, lead(w1, 1) over q as w2, lead(w1, 2) over q as w3 from t window q as (partition by piece_no order by i)),
        f1 as (select lang, w1, count(*) as f from u group by all),
        f2 as (select lang, w1, w2, count(*) as f from u where w2 is not null group by all),
        f3 as (select lang, w1, w2, w3, count(*) as f from u where w3 is not null group by all having count(*) >= 10),
        tot as (select lang, cast(sum(f) as bigint) as n from f1 group by lang),
        longer as (select lang, w1, w2, max(f) as m from (select lang, w1, w2, f from f3 union all select lang, w2, w3, f from f3) group by all),
        c2 as (
            select b.lang, b.w1 || ' ' || b.w2 as phrase, b.f as a, x.f as l, y.f as r, cast(1000000::hugeint * b.f * b.f // (x.f::hugeint * y.f) as bigint) as score
            from f2 b join f1 x on x.lang = b.lang and x.w1 = b.w1 join f1 y on y.lang = b.lang and y.w1 = b.w2
            left join longer g on g.lang = b.lang and g.w1 = b.w1 and g.w2 = b.w2 where b.f >= 10 and (g.m is null or 100 * g.m < 50 * b.f)),
        c3 as (
            select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3 as phrase, c.f as a, x.f as l_1, yz.f as r_1, xy.f as l_2, z.f as r_2,
                   cast(1000000::hugeint * c.f * c.f // (x.f::hugeint * yz.f) as bigint) as s_1, cast(1000000::hugeint * c.f * c.f // (xy.f::hugeint * z.f) as bigint) as s_2
            from f3 c join f1 x on x.lang = c.lang and x.w1 = c.w1 join f2 yz on yz.lang = c.lang and yz.w1 = c.w2 and yz.w2 = c.w3
            join f2 xy on xy.lang = c.lang and xy.w1 = c.w1 and xy.w2 = c.w2 join f1 z on z.lang = c.lang and z.w1 = c.w3),
        c as (
            select * from c2 union all
            select lang, phrase, a, case when s_1 <= s_2 then l_1 else l_2 end, case when s_1 <= s_2 then r_1 else r_2 end, least(s_1, s_2) from c3),
        ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from c)
        select k.lang, rank, phrase, a, l, r, n, score from ranked k join tot on tot.lang = k.lang where rank <= 2000""",
    "op12_line_dedup": """
        with l as (
            select doc_id, unnest(x) as line, generate_subscripts(x, 1) as pos, len(x) as n_lines from (select doc_id, string_split(coalesce(text, ''), chr(10)) as x from documents)),
        k as (select *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) as key from l),
        c as (select key from k where length(key) >= 1 group by key having count(distinct doc_id) >= 10)
        select doc_id, max(n_lines) as n_lines, count(c.key) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where c.key is null), '')) as kept_sha256
        from k left join c on c.key = k.key group by doc_id""",
    "op13_fill_in_middle": """
        with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as h, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') as u from documents),
        e as (select *, len(u) as n, cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2, cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4 from d),
        f as (select *, least(h1 % (n + 1), h2 % (n + 1)) as lo, greatest(h1 % (n + 1), h2 % (n + 1)) as hi,
                     case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form from e),
        g as (select *, array_to_string(u[1:lo], '') as p, array_to_string(u[lo + 1:hi], '') as m, array_to_string(u[hi + 1:], '') as s from f)
        select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
               sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
        from g""",
}
