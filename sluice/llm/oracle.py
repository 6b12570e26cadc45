"""DuckDB SQL with the results of the queries, where SQL can express them."""

import string

from sluice.llm import license_scan as licenses

LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"
SPACE = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {}


def crc32(points: str) -> str:
    """CRC-32 of a list of byte values, bit by bit."""
    eight = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, z: case when (x & 1) = 1 then xor(x >> 1, 3988292384) else x >> 1 end)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {points}), lambda c, b: {eight}), 4294967295)"


def utf8(text: str) -> str:
    """Byte values of a text of characters up to U+00FF."""
    return f"""flatten(list_transform(string_split({text}, ''), lambda ch: case when unicode(ch) < 128 then [unicode(ch)::bigint]
      else [(192 + unicode(ch) // 64)::bigint, (128 + unicode(ch) % 64)::bigint] end))"""


FILLING = """
sums{i} as (
  select *, sum(size) over (partition by source, drawn_in and more = 0 and (size <= room or {i} = 1) order by odds, doc_id, size rows between unbounded preceding and current row) as upto,
    drawn_in and more = 0 and (size <= room or {i} = 1) as waits
  from round{before}
),
marks{i} as (select * exclude (upto, waits, more), case when waits and upto <= room then 1 else more end as more, waits and upto <= room as now from sums{i}),
round{i} as (
  select * exclude (room, now), room - coalesce(sum(size) filter (where now) over (partition by source), 0) as room from marks{i}
),
"""

ORACLE["op10_exact_dedup"] = f"""
with hashed as (select doc_id, sha256(translate(coalesce(text, ''), {LOWER})) as text_sha256 from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, text_sha256
from hashed window g as (partition by text_sha256)
"""

ORACLE["op6_line_dedup"] = f"""
with lines as (
  select doc_id, generate_subscripts(parts, 1) as place, unnest(parts) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents)
),
keyed as (select *, translate(trim(line, {SPACE}), {LOWER}) as key from lines),
common as (select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10),
marked as (select *, key in (select key from common) as gone from keyed)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

ORACLE["op5_source_mixing"] = r"""
with sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents
),
sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
  from sizes group by source
),
capped as (
  select *, ([3.0, 1.0, 2.0])[place % 3 + 1]::double as weight, (source_size * 2)::double as ceiling from sources
),
steps as (
  select *,
    (sum(source_size) over ())::double * 1.5 - coalesce(sum(ceiling) over b, 0.0) as open,
    sum(weight) over () - coalesce(sum(weight) over b, 0.0) as weights
  from capped
  window b as (order by ceiling / weight, place rows between unbounded preceding and 1 preceding)
),
level as (
  select arg_min(open / weights, (ceiling / weight, place)) as level from steps where weight * open <= ceiling * weights
),
targets as (
  select source, source_size, least(ceiling, coalesce(weight * level, ceiling)) as target from steps, level
),
open as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole,
    target - case when source_size > 0 then floor(target / source_size)::bigint else 0 end * source_size as extra
  from targets
),
by_size as (select source, size, count(*)::bigint as n from sizes where size > 0 group by all),
cuts as (
  select *, coalesce(sum(n * size) over (partition by source order by size desc rows between unbounded preceding and 1 preceding), 0)::bigint as certain,
    sum((n * size)::double * size) over (partition by source order by size rows between unbounded preceding and current row) as squares,
    min(size) over (partition by source order by size desc rows between unbounded preceding and 1 preceding) as above
  from by_size
),
chosen as (
  select c.source, max(struct_pack(size := c.size, per_word := (extra - certain) / squares, above := above)) as cut
  from cuts c join open o on c.source is not distinct from o.source
  where extra > 0 and (extra - certain) / squares > 0 and (extra - certain) / squares * c.size <= 1
  group by c.source
),
ranked as (
  select s.doc_id, s.source, s.size, o.source_size, o.target, o.whole, o.extra, s.size * cut.per_word as chance,
    cut.above is not null and s.size >= cut.above as certain,
    (('0x' || substr(md5('7:' || coalesce(s.doc_id::varchar, 'null')), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as drawn
  from sizes s join open o on s.source is not distinct from o.source left join chosen c on s.source is not distinct from c.source
),
odds as (
  select *, case when certain or chance >= 1 then 0.0 when chance > 0 then drawn / (1 - drawn) / (chance / (1 - chance)) end as odds from ranked
),
round0 as (
  select *, extra > 0 and odds is not null as drawn_in, case when extra > 0 and odds = 0 then 1 else 0 end as more,
    extra - coalesce(sum(size) filter (where extra > 0 and odds = 0) over (partition by source), 0) as room
  from odds
),
""" + "".join(FILLING.format(i=i, before=i - 1) for i in range(1, 5)) + """
done as (select * from round4)
select doc_id, size, source_size, target, ((whole + more) * size)::bigint as taken
from done
"""

ORACLE["op4_chat_formatting"] = rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
escaped as (
  select *, regexp_replace(replace(text, '\', '\\'), '(<)(/s>|s>|<SYS>>|</SYS>>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g') as body,
    regexp_replace(replace(role, '\', '\\'), '(<)(/s>|s>|<SYS>>|</SYS>>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g') as head
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(head) + length(body) + 20)::bigint as formatted_chars
from escaped group by conv_id
"""


def _license_words() -> str:
    """Rows ``(label, base, place, word, mandatory)`` of the phrases and templates."""
    rows = [(label, True, i, w, True) for phrase, label in licenses.PHRASES.items() for i, w in enumerate(phrase.split())]
    for label, (template, key) in licenses.TEMPLATES.items():
        words, key = template.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        rows += [(label, False, i, w, at <= i < at + len(key)) for i, w in enumerate(words)]
    return ", ".join(f"('{label}', {base}, {i}, '{w}', {key})" for label, base, i, w, key in rows)


def _text_words() -> str:
    """Rows ``(label, place, word)`` of the whole texts."""
    return ", ".join(f"('{label}', {i}, '{w}')" for label, (text, _) in licenses.TEXTS.items() for i, w in enumerate(licenses.words_of(text)))


def _text_keys() -> str:
    """Rows ``(label, key, place, word)`` of the key phrases of the whole texts."""
    rows = []
    for label, (text, keys) in licenses.TEXTS.items():
        for n, key in enumerate(map(licenses.words_of, keys)):
            rows += [(label, n, licenses.place_of(key, licenses.words_of(text)) + i, w) for i, w in enumerate(key)]
    return ", ".join(f"('{label}', {n}, {i}, '{w}')" for label, n, i, w in rows)


ORACLE["op3_license_scan"] = rf"""
with known(label, base, place, word, mandatory) as (values {_license_words()}),
whole(label, place, word) as (values {_text_words()}),
text_keys(label, key, place, word) as (values {_text_keys()}),
texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
),
placed as (
  select doc_id, unnest(words) as word, generate_subscripts(words, 1) - 1 as at from texts
),
hits as (select * from placed where word in (select word from known union all select word from whole)),
counts as (
  select k.word, ln(((select count(*) from texts) + 1) / (count(distinct h.doc_id) + 1)) as idf, count(distinct h.doc_id) as docs
  from (select word from known union select word from whole) k left join hits h on h.word = k.word group by k.word
),
firsts as (
  select label, word, min(place) as place, any_value(docs) as docs from known join counts using (word) where not base group by label, word
),
rare as (
  select * from firsts qualify row_number() over (partition by label order by docs, place) <= {licenses.RARE_WORDS}
),
needs as (
  select label, any_value(base) as base, count_if(mandatory) as keys, sum(idf) as idf,
    (select ceil(count(*) * {licenses.AGREE}) from rare r where r.label = k.label) as rares
  from known k join counts using (word) group by label
),
starts as (
  select h.doc_id, k.label, h.at - k.place as start, count_if(k.mandatory) as keys, sum(c.idf) as idf, count(r.word) as rares
  from hits h join known k on h.word = k.word join counts c on c.word = k.word
    left join rare r on r.label = k.label and r.word = k.word and r.place = k.place
  group by all
),
text_firsts as (
  select label, word, min(place) as place, any_value(docs) as docs, any_value(idf) as idf from whole join counts using (word) group by label, word
),
text_rare as (
  select * from text_firsts qualify row_number() over (partition by label order by docs, md5(word)) <= (count(*) over (partition by label) + 1) // 2
),
text_needs as (select label, ceil(count(*) * {licenses.AGREE_TEXT}) as n, sum(idf) as idf from text_rare group by label),
posts as (select h.doc_id, r.label, h.at - r.place as start, r.place, r.idf from hits h join text_rare r on h.word = r.word),
agreed as (
  select doc_id, label, start, count(*) as n, sum(idf) as idf from (
    select distinct a.doc_id, a.label, a.start, b.place, b.idf from posts a
    join posts b on a.doc_id = b.doc_id and a.label = b.label and b.start between a.start and a.start + {licenses.DRIFT}
  ) group by doc_id, label, start
),
key_places as (
  select h.doc_id, k.label, h.at - k.place as start from hits h join text_keys k on h.word = k.word
  group by h.doc_id, k.label, k.key, h.at - k.place
  having count(*) = (select count(*) from text_keys t where t.label = k.label and t.key = k.key)
),
text_found as (
  select a.doc_id, a.label, a.start, case when n.idf = 0 then 0 else a.idf / n.idf end as share from agreed a join text_needs n on a.label = n.label and a.n >= n.n
  where exists (select 1 from key_places k where k.doc_id = a.doc_id and k.label = a.label and k.start between a.start and a.start + {licenses.DRIFT})
),
found as (
  select s.doc_id, s.label, s.start, n.base, case when n.base then {licenses.PHRASE_SCORE} when n.idf = 0 then 0 else s.idf / n.idf end as share
  from starts s join needs n on s.label = n.label and s.keys = n.keys and (n.base or s.rares >= n.rares)
  union all select doc_id, label, start, false, share from text_found
)
select t.doc_id, len(any_value(t.words)) as n_words, count(*) filter (where f.base) as n_base,
  min(f.start) filter (where f.base) as first_word, max(f.start) filter (where f.base) as last_word,
  coalesce(string_agg(distinct f.label, ',' order by f.label) filter (where f.base), '') as base_labels,
  coalesce(string_agg(distinct f.label, ',' order by f.label), '') as labels,
  round(least(1.0, coalesce(max(f.share), 0.0))::double, 6) as score
from texts t left join found f on t.doc_id = f.doc_id group by t.doc_id
"""

ORACLE["op9_minhash_dedup"] = rf"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x20\x09-\x0D]+') as words from documents
),
sets as (
  select doc_id, list_distinct(case when len(words) = 0 then []
    else list_transform(range(1, greatest(len(words) - 4, 1) + 1), lambda i: array_to_string(words[i : i + 4], ' ')) end) as shingles
  from texts
),
members as (select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets),
links as (
  select a.doc_id as x, b.doc_id as y
  from members a join members b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reached as (
  select doc_id, doc_id as label from sets
  union
  select l.y, r.label from reached r join links l on r.doc_id = l.x
),
components as (select doc_id, min(label) as component_id from reached group by doc_id)
select doc_id, len(shingles) as n_shingles, component_id, doc_id = component_id as kept
from sets join components using (doc_id)
"""

ORACLE["op11_spelling_variants"] = rf"""
with runs as (
  select doc_id, word, count(*) as n
  from (select doc_id, unnest(regexp_extract_all(translate(text, {LOWER}), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as word from documents) group by all
),
hashed as (
  select word, n, {crc32(utf8("coalesce(doc_id::varchar, '') || ':' || word"))} as h from runs
),
shown as (
  select n, case when h % 97 = 0 then substr(word, 1, (h % length(word))::bigint) || substr(word, (h % length(word))::bigint + 2) else word end as word from hashed
),
words as (select word, sum(n)::bigint as n from shown group by word having length(word) >= 5 and sum(n) >= 3),
lacking as (
  select word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) as rest
  from (select *, unnest(generate_series(1, length(word))) as place from words)
),
pairs as (
  select a.word, b.word as other, b.n from lacking a join lacking b on a.rest = b.rest and a.place = b.place and a.word <> b.word
  union
  select a.word, b.word, b.n from lacking a join words b on a.rest = b.word
  union
  select b.word, a.word, a.n from lacking a join words b on a.rest = b.word
),
near as (select word, count(*) as n_near, arg_min(other, (-n, other)) as form, max(n) as form_n from pairs group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when form_n >= 2 * w.n then form end as form, case when form_n >= 2 * w.n then form_n end as form_n
  from words w left join near using (word)
),
steps as (
  select word, word as root, form as next, 0 as step from forms
  union all
  select s.word, s.next, f.form, s.step + 1 from steps s join forms f on s.next = f.word
),
roots as (select word, arg_max(root, step) as root from steps group by word)
select f.word, form, root, n, n_near, form_n from forms f join roots using (word)
""".replace("with runs", "with recursive runs", 1)

ORACLE["op12_prefix_trie"] = rf"""
with turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as place,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
),
convs as (select conv_id, conv_id - conv_id % 20 as head, {crc32(utf8("conv_id::varchar"))} % 4 as h from turns group by conv_id),
joined as (
  select c.conv_id, 0 as part, t.place, role, text from convs c join turns t on t.conv_id = c.head and t.place <= c.h
  union all
  select c.conv_id, 1, t.place, role, text from convs c join turns t on t.conv_id = c.conv_id and t.place > c.h
),
rebuilt as (select conv_id, row_number() over (partition by conv_id order by part, place) as depth, role, text from joined),
paths as (
  select conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '' order by depth) over (partition by conv_id order by depth) as node,
    coalesce(string_agg(length(role) || ':' || role || length(text) || ':' || text, '' order by depth) over (partition by conv_id order by depth rows between unbounded preceding and 1 preceding), '') as above
  from rebuilt
  union all
  select conv_id, 0, 0, '', null from convs
),
nodes as (
  select node, depth, any_value(above) as above, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words from paths group by node, depth
),
children as (select above as node, count(*) as n_children from nodes where depth > 0 group by above),
below as (
  select distinct a.node, a.depth, b.node as lower, b.depth as lower_depth from paths a join paths b on a.conv_id = b.conv_id and b.depth >= a.depth
),
subtrees as (
  select b.node, b.depth, count(*) filter (where c.node is null) as n_leaves, sum((n.n_convs - 1) * n.words)::bigint as saved_tokens
  from below b join nodes n on n.node = b.lower and n.depth = b.lower_depth left join children c on c.node = b.lower group by b.node, b.depth
),
lasts as (select conv_id, max(depth) as depth from paths group by conv_id),
ends as (
  select p.node, p.depth, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends_sha256
  from paths p join lasts l using (conv_id, depth) group by p.node, p.depth
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, s.n_leaves, s.saved_tokens,
  coalesce(e.ends_sha256, sha256('')) as ends_sha256
from nodes n join subtrees s on s.node = n.node and s.depth = n.depth
  left join nodes p on n.depth > 0 and p.node = n.above and p.depth = n.depth - 1
  left join children c on c.node = n.node left join ends e on e.node = n.node and e.depth = n.depth
"""
