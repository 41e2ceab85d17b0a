"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tallyloom.llm.chat import INSTRUCT


def _chat_format() -> str:
    def count_of(control: str) -> str:
        return f"(length(said) - length(replace(said, '{control}', ''))) / {len(control)}"

    grown = " + ".join([r"length(said) - length(replace(said, '\', ''))"] + [count_of(c) for c in INSTRUCT.controls()])
    cases = " ".join(
        f"when '{name}' then {len(m.opening) + len(m.closing)}" for name, m in INSTRUCT.roles.items()
    )
    fits = " or ".join(
        f"(state = '{state}' and who in ({', '.join(repr(n) for n in nexts)}))"
        for state, nexts in INSTRUCT.follows.items()
    )
    other = sum(map(len, (INSTRUCT.other_opening, INSTRUCT.other_named, INSTRUCT.other_closing)))
    return f"""
    with chats as (
        select conv_id, turn, coalesce(role, '') as who, coalesce(text, '') as said from conversations
        union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
        union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), sized as (
        select *, cast(length(said) + {grown} + case who {cases} else {other} + length(who) end as bigint)
                  as formatted_chars,
               row_number() over w as n, count(*) over (partition by conv_id) as n_all,
               coalesce(lag(who) over w, '^') as state
        from chats window w as (partition by conv_id order by turn nulls first, who, said)
    )
    select conv_id, count(*) as n_turns,
           sha256(string_agg(who || chr(10) || said || chr(10), '' order by n)) as turns_sha256,
           cast(coalesce(sum(length(said)) filter (who = 'assistant'), 0) as bigint) as loss_chars,
           sha256(coalesce(string_agg(said, '' order by n) filter (who = 'assistant'), '')) as loss_sha256,
           cast(sum(formatted_chars) as bigint) as formatted_chars,
           bool_and({fits}) and bool_and(n < n_all or who = 'assistant') as valid
    from sized group by conv_id
    """


EXACT_TOPK = """
    with vectors as (
        select vec_id, [cast(floor(64 * cast(x as double)) as bigint) for x in embedding] as v
        from embeddings
        where len(embedding) > 0
          and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)
    ), scored as (
        select q.vec_id as query_id, c.vec_id as vec_id,
               cast(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) as bigint) as score
        from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
        where q.vec_id % 20 = 0
    ), ranked as (
        select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
        from scored
    )
    select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""

# All shingle pairs: for the small tables of a comparison only.
NEAR_DEDUP = r"""
    with recursive texts as (
        select doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') as w
        from documents
    ), sets as (
        select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
            else list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) end as s
        from texts
    ), shingles as (
        select doc_id, len(s) as n, unnest(s) as x from sets
    ), links as (
        select a.doc_id as a, b.doc_id as b
        from shingles a join shingles b on a.x = b.x and a.doc_id < b.doc_id
        group by a.doc_id, b.doc_id, a.n, b.n
        having 100 * count(*) >= 75 * (a.n + b.n - count(*))
    ), both_ways as (
        select a, b from links union all select b, a from links
    ), reached as (
        select doc_id, doc_id as root from sets
        union
        select both_ways.b as doc_id, reached.root from reached join both_ways on reached.doc_id = both_ways.a
    ), components as (
        select doc_id, min(root) as component_id from reached group by doc_id
    )
    select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
    from sets join components using (doc_id)
"""

# One row for every byte position: for the small tables of a comparison only.
SUFFIX_DEDUP = """
    with texts as (
        select doc_id, hex(encode(coalesce(text, ''))) as x from documents
    ), windows as (
        select doc_id, i, substr(x, 2 * i + 1, 100) as s
        from (select doc_id, x, unnest(range(0, greatest(length(x) // 2 - 49, 0))) as i from texts)
    ), firsts as (
        select s, min(doc_id) as f from windows group by s
    ), hits as (
        select doc_id, i, lag(i) over (partition by doc_id order by i) as before
        from windows join firsts using (s) where doc_id > f
    ), numbered as (
        select doc_id, i, sum(case when before is null or i > before + 50 then 1 else 0 end)
               over (partition by doc_id order by i) as span
        from hits
    ), spans as (
        select doc_id, span, min(i) as a, max(i) + 50 as b from numbered group by doc_id, span
    ), pieces as (
        select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as done from spans
    ), joined as (
        select doc_id, string_agg(substr(x, 2 * done + 1, 2 * (a - done)), '' order by a) as front,
               max(b) as tail, count(*) as n_spans, sum(b - a) as n_removed
        from pieces join texts using (doc_id) group by doc_id
    )
    select doc_id, cast(length(x) // 2 as bigint) as n_bytes,
           cast(coalesce(n_removed, 0) as bigint) as n_removed,
           cast(coalesce(n_spans, 0) as bigint) as n_spans,
           sha256(unhex(coalesce(front, '') || substr(x, 2 * coalesce(tail, 0) + 1))) as kept_sha256
    from texts left join joined using (doc_id)
"""

# The common CRC-32 (reflected polynomial EDB88320) of UTF-8 hex text: its table, then one
# step for each byte.
CRC_TABLE = """
    crc_table as materialized (
        select list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, _:
                    case when (c & 1) = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as crcs
        from (select cast(unnest(range(256)) as bigint) as i)
    )"""


def _crc32(text: str) -> str:
    codes = f"[cast(concat('0x', substr(hex(encode({text})), 2 * i - 1, 2)) as bigint) for i in range(1, octet_length(encode({text})) + 1)]"
    return f"""xor(4294967295, list_reduce([cast(4294967295 as bigint)] || {codes}, lambda c, b:
        xor(c >> 8, crcs[(xor(c, b) & 255) + 1])))"""


def _merkle_manifest() -> str:
    def field(name: str, value: str) -> str:
        text = f"cast({value} as varchar)"
        return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"

    def leaf(n_chars: str) -> str:
        values = ("doc_id", "source", "lang", n_chars, "text")
        return "sha256(" + " || ".join(field(v, v) for v in values) + ")"

    def levels(name: str, of: str) -> str:
        return f"""
    {name} as (
        select tree, 0 as level, place, size, h from {of}
        union all
        select tree, any_value(level) + 1, place // 2, (any_value(size) + 1) // 2, sha256(string_agg(h, '' order by place))
        from {name} where size > 1 group by tree, place // 2
    )"""

    tampers = f"{_crc32('cast(doc_id as varchar)')} % 7 = 0"
    return f"""
    with recursive {CRC_TABLE}, leaves as (
        select doc_id, lang, {leaf("n_chars")} as leaf,
               case when {tampers} then {leaf("n_chars + 1")} else {leaf("n_chars")} end as seen
        from documents, crc_table
    ), placed as (
        select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as place,
               dense_rank() over (order by lang nulls first) - 1 as tree,
               count(*) over (partition by lang) as size, row_number() over () as row
        from leaves
    ), starts as (
        select tree, place, size, leaf as h from placed
    ), {levels("nodes", "starts")}, langs as (
        select 0 as tree, tree as place, count(*) over () as size, h from nodes where size = 1
    ), {levels("tops", "langs")}, steps as (
        select row, l.level, n.h, ((placed.place >> l.level) & 1) = 1 as left_of
        from placed join (select distinct tree, level, size from nodes where size > 1) l using (tree)
        left join nodes n on n.tree = placed.tree and n.level = l.level and n.place = xor(placed.place >> l.level, 1)
        union all
        select row, 1000 + l.level, n.h, ((placed.tree >> l.level) & 1) = 1
        from placed, (select distinct level, size from tops where size > 1) l
        left join tops n on n.level = l.level and n.place = xor(placed.tree >> l.level, 1)
    ), paths as (
        select row, list(coalesce(case when left_of then 'l' else 'r' end || h, '-') order by level) as path,
               string_agg(h, '' order by level) as siblings
        from steps group by row
    ), folded as (
        select doc_id, leaf, sub.h as subroot, top.h as root, sha256(coalesce(siblings, '')) as proof_sha256,
               list_reduce([seen] || coalesce(path, []), lambda a, s: sha256(
                   case s[1] when 'l' then s[2:] || a when 'r' then a || s[2:] else a end)) as folded_root
        from placed left join paths using (row)
        join (select tree, h from nodes where size = 1) sub using (tree),
             (select h from tops where size = 1) top
    )
    select *, folded_root = root as verified from folded
    """


RESAMPLING = rf"""
    with {CRC_TABLE}, worded as (
        select *, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
        from (select true as mine, row_number() over () as row, doc_id, text from documents
              union all select false, -1, -1, text from benchmark)
    ), runs as (
        select mine, row, unnest(
            w || [w[i] || ' ' || w[i + 1] for i in range(1, len(w))]
              || [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]) as feature
        from worded
    ), counted as (
        select mine, row, feature, count(*) as n from runs group by all
    ), known as (
        select feature, {_crc32("feature")} % 10000 as bucket
        from (select distinct feature from counted), crc_table
    ), sums as (
        select bucket, coalesce(sum(n) filter (mine), 0) as s, coalesce(sum(n) filter (not mine), 0) as t
        from counted join known using (feature) group by bucket
    ), gains as (
        select bucket, cast(floor(1000 * ln((t + 1.0::double) * (sum(s) over () + 10000.0::double)
                   / ((s + 1.0::double) * (sum(t) over () + 10000.0::double)))) as bigint) as gain
        from sums
    ), weights as (
        select row, sum(n) as n_features, sum(n * gain) as weight
        from counted join known using (feature) join gains using (bucket) where mine group by row
    ), draws as (
        select doc_id, len(w) as n_words, cast(coalesce(n_features, 0) as bigint) as n_features,
               cast(coalesce(weight, 0) as bigint) as weight,
               cast(concat('0x', sha256('42:' || coalesce(cast(doc_id as varchar), ''))[:8]) as bigint) as h
        from worded left join weights using (row) where mine
    ), scored as (
        select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296.0::double))) as bigint) as score
        from draws
    ), ranked as (
        select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls first, weight, n_features) as r,
               count(*) filter (n_words >= 20) over () as enough
        from scored
    )
    select doc_id, n_features, weight, score,
           case when n_words >= 20 and r <= 5 * enough // 100 then r end as rank
    from ranked
"""

ORACLE_SQL: dict[str, str] = {
    "op2_exact_topk": EXACT_TOPK,
    "op3_chat_format": _chat_format(),
    "op6_minhash_near_dedup": NEAR_DEDUP,
    "op7_suffix_dedup": SUFFIX_DEDUP,
    "op12_merkle_manifest": _merkle_manifest(),
    "op13_resampling": RESAMPLING,
}
