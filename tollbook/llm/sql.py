"""SQL twins of the queries that SQL can express over whole tables.

Operators 1, 3, 7, 9 and 12 need tokenizers, 5 files, and 4 and 6 fitted models.
"""

from __future__ import annotations

#: The words of a text, and A-Z as a-z.
WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 of an ASCII text: a step for each byte over the table of a byte's eight steps.
CRC_TABLE = """
crc_table as (
  select list(list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) order by n) as steps
  from (select cast(range as bigint) as n from range(256)))"""


def crc32(text: str) -> str:
    letters = f"list_transform(string_split({text}, ''), lambda x: cast(ascii(x) as bigint))"
    return (
        f"xor(list_reduce(list_prepend(4294967295::bigint, {letters}), "
        "lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), 4294967295)"
    )


def reached(links: str) -> str:
    """Every two (``a``, ``b``) that a table's links (``x``, ``y``, both ways) connect."""
    return f"""
reached as (
  select r as a, r as b from numbered
  union
  select reached.a, {links}.y from reached join {links} on reached.b = {links}.x)"""


SUBSTRING_DEDUP = f"""
with numbered as (
  select row_number() over () as r, doc_id, {WORDS.format(text="coalesce(text, '')")} as words from documents),
starts as (select r, unnest(range(1, len(words) - 33)) as i from numbered where len(words) >= 35),
windows as (
  select r, i, sha256(array_to_string(list_slice(words, i, i + 34), ' ')) as h from starts join numbered using (r)),
again as (select r, i from (select *, count(*) over (partition by h) as n from windows) where n > 1),
gone as (select distinct r, unnest(range(i, i + 35)) as k from again),
each as (select r, unnest(words) as word, generate_subscripts(words, 1) as k from numbered)
select any_value(n.doc_id) as doc_id, cast(any_value(len(n.words)) as bigint) as n_words,
  count(gone.k) as n_removed,
  sha256(coalesce(string_agg(word, ' ' order by k) filter (where gone.k is null), '')) as kept_sha256
from numbered n left join each using (r) left join gone using (r, k) group by r"""

NGRAM_JOIN = f"""
with recursive numbered as (
  select row_number() over () as r, doc_id, {WORDS.format(text=LOWER)} as words from documents),
shingles as (
  select distinct r, array_to_string(list_slice(words, i, i + 4), ' ') as s
  from (select r, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from numbered where len(words) > 0)),
sizes as (select r, count(*) as n from shingles group by r),
shared as (
  select a.r as x, b.r as y, count(*) as common from shingles a join shingles b on a.s = b.s and a.r <> b.r group by all),
links as (
  select x, y from shared join sizes a on a.r = x join sizes b on b.r = y where 100 * common >= 75 * (a.n + b.n - common)),
{reached("links")}
select n.doc_id, coalesce(any_value(s.n), 0) as n_shingles, min(other.doc_id) as component_id
from numbered n left join sizes s using (r) join reached on reached.a = n.r join numbered other on other.r = reached.b
group by n.r, n.doc_id"""

VECTOR_JOIN = f"""
with recursive numbered as (select row_number() over () as r, vec_id, cast(embedding as double[]) as v from embeddings),
usable as (
  select r, v from numbered
  where len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(v, lambda x: x <> 0)) > 0),
links as (
  select a.r as x, b.r as y from usable a join usable b
    on a.r <> b.r and len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.95),
{reached("links")},
counted as (select x as r, count(*) as n from links group by x)
select n.vec_id, coalesce(any_value(c.n), 0) as n_links, min(other.vec_id) as component_id,
  n.vec_id = min(other.vec_id) as kept
from numbered n left join counted c using (r) join reached on reached.a = n.r join numbered other on other.r = reached.b
group by n.r, n.vec_id"""

TURN_REPAIR = f"""
with recursive {CRC_TABLE.strip()},
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind in (0, 1) then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    kind, unnest(case when kind = 3 then [1, 2] else [1] end) as copy
  from (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
      {crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as kind
    from conversations, crc_table)),
bare as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
    regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g') as said
  from damaged where kind <> 0),
faults as (
  select *, left(role, 1) as initial,
    case when said = '' then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when right(said, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault
  from bare),
counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where before || initial not in ('su', 'ua', 'au')) as illegal
  from (select *, lag(initial) over (partition by conv_id order by i) as before from faults) group by conv_id),
-- A label is ten digits of cost and the audit, so that the least text is the best one.
steps as (
  select distinct conv_id, 0 as i, '0000000000' as at_start, cast(null as varchar) as at_s,
    cast(null as varchar) as at_u, cast(null as varchar) as at_a
  from conversations
  union all
  select conv_id, i,
    {{d}},
    least({{d_s}}, {{keep_s}}),
    least({{d_u}}, {{to_u}}),
    least({{d_a}}, {{to_a}})
  from (
    select f.conv_id, f.i, f.initial, f.fault, p.at_start as st, p.at_s as s,
      least(p.at_u, {{in_st}}, {{in_s}}, {{in_a}}) as u, p.at_a as a0,
      least(p.at_a, {{in_u}}) as a
    from steps p join faults f on f.conv_id is not distinct from p.conv_id and f.i = p.i + 1)),
ended as (
  select s.conv_id, least(at_start, at_a, {{end_a}}) as label
  from steps s left join counted c on c.conv_id is not distinct from s.conv_id where s.i = coalesce(c.n, 0)),
walk as (
  select conv_id, substr(label, 11) as rest, 0 as i, '' as state, cast([] as varchar[]) as lines from ended
  union all
  select w.conv_id, substr(rest, 2), w.i + (left(rest, 1) <> 'I')::int,
    case when left(rest, 1) = 'D' then state when left(rest, 1) = 'K' and state = '' and f.initial = 's' then 's'
      when state = 'u' then 'a' else 'u' end,
    case when left(rest, 1) = 'D' then lines else list_append(lines,
      case when left(rest, 1) = 'K' then f.role when state = 'u' then 'assistant' else 'user' end || ':'
        || case when left(rest, 1) = 'I' then '' else f.text end) end
  from walk w left join faults f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1 and left(rest, 1) <> 'I'
  where rest <> '')
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(left(label, 10) as bigint) as cost,
  substr(label, 11) as audit, sha256(array_to_string(lines, chr(10))) as repaired_sha256
from ended e join walk w on w.conv_id is not distinct from e.conv_id and w.rest = ''
left join counted c on c.conv_id is not distinct from e.conv_id"""


def edit(label: str, cost: str, letter: str) -> str:
    return f"lpad(cast(cast(left({label}, 10) as bigint) + {cost} as varchar), 10, '0') || substr({label}, 11) || '{letter}'"


def _edits() -> dict[str, str]:
    more = "case fault when 'truncated' then 5 else 0 end"
    usable = "fault in ('', 'truncated')"

    def read(label: str, role: str) -> str:
        """The least of keeping and reroling a row, from a state that needs this role."""
        kept = f"case when initial = '{role}' then {edit(label, more, 'K')} end"
        return f"case when {usable} then least({kept}, {edit(label, f'1 + {more}', 'R')}) end"

    u = f"least(p.at_u, {edit('p.at_start', '5', 'I')}, {edit('p.at_s', '5', 'I')}, {edit('p.at_a', '5', 'I')})"
    last = u.replace("p.", "")
    return {
        "d": edit("st", "2", "D"), "d_s": edit("s", "2", "D"), "d_u": edit("u", "2", "D"), "d_a": edit("a", "2", "D"),
        "keep_s": f"case when {usable} and initial = 's' then {edit('st', more, 'K')} end",
        "to_u": f"{read('st', 'u')}, {read('s', 'u')}, {read('a', 'u')}",
        "to_a": read("u", "a"),
        "in_st": edit("p.at_start", "5", "I"), "in_s": edit("p.at_s", "5", "I"), "in_a": edit("p.at_a", "5", "I"),
        "in_u": edit(u, "5", "I"), "end_a": edit(last, "5", "I"),
    }


PREFIX_TRIE = f"""
with {CRC_TABLE.strip()},
own as (
  select conv_id, list(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')
      order by turn nulls first, role, text) as turns,
    list(strlen(coalesce(text, '')) order by turn nulls first, role, text) as sizes
  from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)
  group by conv_id),
heads as (select *, {crc32("cast(conv_id as varchar)")} % 9 as h from own, crc_table),
rebuilt as (
  select c.conv_id,
    list_concat(list_slice(coalesce(b.turns, []), 1, h), list_slice(c.turns, h + 1, len(c.turns))) as turns,
    list_concat(list_slice(coalesce(b.sizes, []), 1, h), list_slice(c.sizes, h + 1, len(c.sizes))) as sizes
  from heads c left join own b on b.conv_id = c.conv_id - (c.conv_id % 5 + 5) % 5),
depths as (select *, unnest(range(0, len(turns) + 1)) as depth from rebuilt),
paths as (
  select conv_id, depth, sizes[depth] as size, depth = len(turns) as ends,
    sha256(array_to_string(list_transform(list_slice(turns, 1, depth), lambda t: length(t) || '#' || t), '')) as node,
    sha256(array_to_string(list_transform(list_slice(turns, 1, depth - 1), lambda t: length(t) || '#' || t), '')) as parent
  from depths),
nodes as (
  select depth, node, any_value(case when depth > 0 then parent end) as parent, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(any_value(size), 0) as size,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ends), '')) as ends_sha256
  from paths group by depth, node),
children as (select depth - 1 as depth, parent as node, count(*) as n from nodes where depth > 0 group by all),
trie as (
  select nodes.*, coalesce(children.n, 0) as n_children from nodes left join children using (depth, node)),
below as (
  select p.depth, p.node, count(*) filter (where t.n_children = 0) as n_leaves, sum((t.n_convs - 1) * t.size) as saved
  from trie t join paths p on p.conv_id = t.conv_id and p.depth <= t.depth group by all)
select t.conv_id, t.depth, up.conv_id as parent_conv_id, t.n_convs, t.n_children, n_leaves,
  cast(saved as bigint) as saved_tokens, t.ends_sha256
from trie t join below using (depth, node) left join trie up on up.depth = t.depth - 1 and up.node = t.parent"""

SQL: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING_DEDUP,
    "op8_ngram_join": NGRAM_JOIN,
    "op10_vector_join": VECTOR_JOIN,
    "op11_turn_repair": TURN_REPAIR.format(**_edits()),
    "op13_prefix_trie": PREFIX_TRIE,
}
