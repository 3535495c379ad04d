"""DuckDB SQL for the queries whose results it can state."""

ORACLES = {
    "op3_exact_dedup": r"""
with n as (
    select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
)
select doc_id,
       first_value(doc_id) over (partition by norm order by doc_id nulls last) as keep_id,
       count(*) over (partition by norm) as group_size,
       row_number() over (partition by norm order by doc_id nulls last) = 1 as kept,
       sha256(norm) as text_sha256
from n
""",
    "op10_substring": r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
windows as (
    select doc_id, i, array_to_string(ws[i:i + 12], ' ') as passage
    from (select doc_id, ws, unnest(range(1, len(ws) - 11)) as i from w where len(ws) >= 13)
),
firsts as (select passage, min(doc_id) as first_id from windows group by passage),
gone as (
    select distinct doc_id, i + j as pos
    from (select doc_id, i from windows join firsts using (passage) where first_id < doc_id), (select unnest(range(0, 13)) as j)
),
words as (select doc_id, unnest(range(1, len(ws) + 1)) as pos, unnest(ws) as word from w),
kept as (
    select doc_id, count(g.pos) as n_removed, string_agg(word, ' ' order by pos) filter (where g.pos is null) as text
    from words left join gone g using (doc_id, pos) group by doc_id
)
select w.doc_id, len(ws) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)
""",
    "op12_search": r"""
with folded as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
),
d as (select row_number() over () as row, doc_id, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from folded),
q as (
    select row_number() over () as item, item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
),
asked as (select item, item_id, term, count(*) as times from q group by all),
total as (select count(*) filter (where len(ts) > 0) as n_docs, sum(len(ts))::bigint as n_terms from d),
counted as (
    select row, doc_id, n, term, count(*) as tf from (select row, doc_id, len(ts) as n, unnest(ts) as term from d)
    where term in (select term from asked) group by all
),
w as (
    select term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from counted, total group by term, n_docs
),
v as (
    select row, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))) as v
    from counted join w using (term), total
),
scored as (
    select item, item_id, row, doc_id, sum(times * v)::bigint as score from asked join v using (term) group by all having sum(times * v) > 0
)
select item_id, cast(row_number() over (partition by item order by score desc, doc_id nulls last) as int) as rank, doc_id, score
from scored qualify rank <= 20
""",
}


def _merkle(leaf_levels: int = 6, top_levels: int = 4) -> str:
    """SQL of the manifest, level by level: sources of up to 16^6 rows, up to 16^4 sources."""
    value = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || {0}::varchar end"
    head = " || ".join(value.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
    steps = [
        # crc32 bit by bit, least significant first.
        r"""
crc as (
    select row, doc_id, source, lang, n_chars, text, xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, flatten(list_transform(range(1, len(doc_id::varchar) + 1),
            lambda i: list_transform(range(0, 8), lambda k: (ascii(substr(doc_id::varchar, i, 1)) >> k) & 1)))),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)))) as crc
    from (select row_number() over () as row, * from documents)
)""",
        f"""
t as (
    select row, doc_id, source, sha256({head} || {value.format('text')}) as leaf,
        case when crc % 5 = 0 then sha256({head} || {value.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")})
        else leaf end as cur
    from crc
)""",
        """
p0 as (select *, source is not null as has, coalesce(source, '') as src, leaf as node, '' as sibs,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos from t)""",
    ]

    def climb(now: str, new: str, tree: str) -> str:
        # Nodes of a level, the runs they stand in, and every leaf's way up; a tree of one node stays.
        return f"""
{new}_nodes as (select distinct {tree}, pos, node from {now}),
{new}_runs as (select {tree}, pos // 16 as run, list(node order by pos) as l, sum(count(*)) over (partition by {tree}) as n from {new}_nodes group by {tree}, pos // 16),
{new} as (
    select * exclude (run, l, n) replace (
        case when n > 1 then sha256(array_to_string(l, '')) else node end as node,
        case when n > 1 then sibs || array_to_string(l[1:pos % 16] || l[pos % 16 + 2:], '') else sibs end as sibs,
        case when n > 1 then sha256(array_to_string(l[1:pos % 16] || [cur] || l[pos % 16 + 2:], '')) else cur end as cur,
        pos // 16 as pos
    )
    from {now} join {new}_runs r using ({tree}) where r.run = {now}.pos // 16
)"""

    for k in range(leaf_levels):
        steps.append(climb(f"p{k}", f"p{k + 1}", "has, src"))
    steps.append(f"""
s0 as (select * replace (dense_rank() over (order by has, src) - 1 as pos), node as subroot, 0 as top from p{leaf_levels})""")
    for k in range(top_levels):
        steps.append(climb(f"s{k}", f"s{k + 1}", "top"))
    return f"""with {','.join(steps)}
select doc_id, leaf, subroot, node as root, sha256(sibs) as proof_sha256, cur as folded_root, cur = node as verified from s{top_levels}"""


ORACLES["op13_merkle"] = _merkle()
