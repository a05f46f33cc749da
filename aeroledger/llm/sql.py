"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

WARC = """
with p as (
    select page_id, url, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), g as (
    select *, min(page_id) over (partition by payload_digest) as first_id from p
)
select page_id, url as target_uri,
    case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to,
    payload_bytes, payload_digest,
    '<urn:uuid:' || regexp_replace(left(sha256(page_id || chr(10) || url || chr(10) || payload_digest || chr(10) || '0'), 32),
        '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') || '>' as record_id
from g
"""

CHAT = r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), e as (
    select *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\])', '\1\\\2\3', 'g') as safe,
        regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\]|/?ROLE\])', '\1\\\2\3', 'g') as safe_role
    from c
), s as (
    select *, role = 'assistant' as reply, length(safe) + length('<s></s>') + case role when 'assistant' then 0
        when 'user' then length('[INST]  [/INST]') else length('[ROLE]  [/ROLE]') + length(safe_role) end as size
    from e
), o as (
    select *, sum(size) over (partition by conv_id order by turn nulls last, role, text rows unbounded preceding) as until from s
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (reply), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (reply), '')) as loss_sha256,
    cast(sum(size) as bigint) as formatted_chars, count(*) filter (reply) as n_examples,
    cast(coalesce(sum(until) filter (reply), 0) as bigint) as example_chars
from o group by conv_id
"""

DECONTAMINATE = r"""
with d as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w from documents
), b as (
    select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w from benchmark
), win as (
    select distinct item_id, w[i:i + least(len(w), 10) - 1] as g from (
        select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)
), sizes as (
    select distinct len(g) as n from win
), grams as (
    select doc_id, i, n, w[i:i + n - 1] as g from (
        select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)
), hit as (
    select distinct doc_id, item_id, i, n from grams join win using (g)
), places as (
    select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (doc_id) left join items using (doc_id)
"""

SQL: dict[str, str] = {"op1_warc": WARC, "op3_chat": CHAT, "op4_decontaminate": DECONTAMINATE}


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, a byte at a time."""
    # The table by its rule: eight shifts of each byte, with the reversed polynomial.
    shift = "lambda t, k: case when t & 1 = 1 then xor(t >> 1, 3988292384) else t >> 1 end"
    rule = f"list_transform(range(256), lambda n: list_reduce(range(8), {shift}, n))"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)"
    step = "lambda c, b: xor(c >> 8, crc_table.t[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({octets}, {step}, 4294967295::bigint), 4294967295)", f"crc_table as (select {rule} as t)"


def _crc(text: str) -> str:
    return crc32(text)[0]


CRC_TABLE = crc32("''")[1]

JUMP = f"""
with recursive {CRC_TABLE}, d as (
    select doc_id, cast(strlen(coalesce(text, '')) + 1 as bigint) as size, {_crc("coalesce(text, '')")} as text_crc32,
        md5(coalesce(cast(doc_id as varchar), '')) as digest
    from documents, crc_table
), keys as (
    select distinct digest from d
), walk as (
    select digest, cast(('0x' || left(digest, 8))::bigint as hugeint) * 4294967296 + ('0x' || substr(digest, 9, 8))::bigint as state,
        cast(-1 as bigint) as b, cast(0 as bigint) as j from keys
    union all
    select digest, next, j, cast(floor((j + 1) * (2147483648.0::double / (cast(next // 8589934592 as double) + 1))) as bigint)
    from (select *, (state * 2862933555777941757 + 1) % 18446744073709551616 as next from walk where j < 17)
), shards as (
    select digest, max(b) filter (b < 16) as shard, max(b) filter (b < 17) as grown from walk group by digest
), placed as (
    select *, md5(coalesce(cast(doc_id as varchar), '') || ':' || size || ':' || text_crc32) as place from d join shards using (digest)
)
select doc_id, size, text_crc32, 'key' as law, cast(shard as integer) as shard,
    row_number() over (partition by shard order by left(place, 16), doc_id nulls first, size, text_crc32) - 1 as slot,
    cast(grown as integer) as grown_shard
from placed
"""

_FIELDS = ("doc_id", "source", "lang", "n_chars")


def _leaf(text: str) -> str:
    parts = [f"cast({c} as varchar)" for c in _FIELDS] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


# Levels of the sources' trees, then of the tree over their roots; every leaf's run at every level.
MERKLE = f"""
with recursive {CRC_TABLE}, leaf as (
    select doc_id, coalesce('=' || source, '') as tree, {_leaf('text')} as leaf,
        case when {_crc("coalesce(cast(doc_id as varchar), '-')")} % 2 = 0 and doc_id is not null
            then {_leaf("replace(text, chr(10), '')")} else {_leaf('text')} end as changed
    from documents, crc_table
), placed as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx from leaf
), low as (
    select tree, 0 as level, idx, leaf as h, count(*) over (partition by tree) as n from placed
    union all
    select tree, level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), max((n + 2) // 3) from low where n > 1
    group by tree, level, idx // 3
), sub as (
    select *, row_number() over (order by tree) - 1 as place from low where n = 1
), high as (
    select 0 as level, place as idx, h, count(*) over () as n from sub
    union all
    select level + 1, idx // 3, sha256(string_agg(h, '' order by idx)), max((n + 2) // 3) from high where n > 1 group by level, idx // 3
), nodes as (
    select tree, level, idx, coalesce(string_agg(h, '') over (run rows between unbounded preceding and 1 preceding), '') as lefts,
        coalesce(string_agg(h, '') over (run rows between 1 following and unbounded following), '') as rights
    from (select tree, level, idx, h from low where n > 1 union all select '!', level, idx, h from high where n > 1)
    window run as (partition by tree, level, idx // 3 order by idx)
), root as (
    select h as root, level as height from high where n = 1
), climb as (
    select p.doc_id, p.tree as home, leaf, changed as fold, '' as met, p.tree, 0 as level, p.idx from placed p
    union all
    select c.doc_id, c.home, c.leaf, case when s.place is null then sha256(n.lefts || c.fold || n.rights) else c.fold end,
        case when s.place is null then c.met || n.lefts || n.rights else c.met end,
        case when s.place is null then c.tree else '!' end, case when s.place is null then c.level + 1 else 0 end,
        case when s.place is null then c.idx // 3 else s.place end
    from climb c left join sub s on c.tree = s.tree and c.level = s.level
        left join nodes n on c.tree = n.tree and c.level = n.level and c.idx = n.idx
    where not (c.tree = '!' and c.level = (select height from root))
)
select c.doc_id, leaf, s.h as subroot, root, sha256(met) as proof_sha256, fold as folded_root, fold = root as verified
from climb c join sub s on s.tree = c.home join root on c.level = root.height where c.tree = '!'
"""

# One step of the repair per row of each conversation: from every state, up to three insertions and an edit of the row.
REPAIR = f"""
with recursive {CRC_TABLE}, keyed as (
    select coalesce('=' || conv_id, '') as conv, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        {_crc("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as hit
    from conversations, crc_table
), damaged as (
    select conv, turn, case when hit = 4 then 'user' else role end as role,
        case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(range(case when hit = 3 then 2 else 1 end)) as copy
    from keyed where hit <> 0
), numbered as (
    select *, row_number() over (partition by conv order by turn nulls first, role, sha256(text), copy) as n from damaged
), marked as (
    select *, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
        row_number() over (partition by conv, role, text order by n) > 1 as again,
        not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') as open, lag(left(role, 1)) over (partition by conv order by n) as before
    from numbered
), facts as (
    select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
        count(*) filter (not blank and again) as duplicate, count(*) filter (not blank and not again and open) as truncated,
        count(*) filter (before is not null and (before || left(role, 1)) not in ('su', 'ua', 'au')) as illegal, max(n) as size
    from marked group by conv
), moves as (
    select * from (values ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')) m(origin, role, target)
), leads as (
    select origin, origin as target, 0 as added, '' as said from (values ('0'), ('s'), ('u'), ('a')) o(origin)
    union all
    select l.origin, m.target, added + 1, said || case m.role when 'u' then 'user:' else 'assistant:' end || chr(10)
    from leads l join moves m on l.target = m.origin where m.role <> 's' and added < 3
), steps as (
    select conv, n, l.origin, l.target as state, 3 * added + 4 as cost, repeat('I', added) || 'D' as edits, said from marked, leads l
    union all
    select conv, n, l.origin, m.target, 3 * added + case when open then 3 else 0 end + case when m.role = left(r.role, 1) then 0 else 3 end,
        repeat('I', added) || case when m.role = left(r.role, 1) then 'K' else 'R' end,
        l.said || case when m.role = left(r.role, 1) then r.role when m.role = 'u' then 'user' else 'assistant' end || ':' || text || chr(10)
    from marked r, leads l join moves m on l.target = m.origin
    where not blank and not again and (m.role = left(r.role, 1) or m.role <> 's')
), walk as (
    select conv, cast(0 as bigint) as n, '0' as state, cast(0 as bigint) as cost, '' as audit, '' as lines from facts
    union all
    select conv, n, state, best.cost, best.audit, best.lines from (
        select w.conv, s.n, s.state, min({{'cost': cast(w.cost + s.cost as bigint), 'audit': w.audit || s.edits, 'lines': w.lines || s.said}}) as best
        from walk w join steps s on w.conv = s.conv and w.n + 1 = s.n and w.state = s.origin group by w.conv, s.n, s.state)
), ended as (
    select w.conv, min({{'cost': w.cost + 3 * added, 'audit': audit || repeat('I', added), 'lines': lines || said}}) as best
    from walk w join facts f on w.conv = f.conv and w.n = f.size join leads l on l.origin = w.state
    where l.target in ('0', 'a') group by w.conv
)
select k.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
    coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost, coalesce(best.audit, '') as audit,
    sha256(coalesce(left(best.lines, length(best.lines) - 1), '')) as repaired_sha256
from (select distinct conv, conv_id from keyed) k left join facts using (conv) left join ended using (conv)
"""

SQL |= {"op11_jump": JUMP, "op12_merkle": MERKLE, "op13_repair": REPAIR}
