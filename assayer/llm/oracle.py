"""SQL for those queries that SQL can express, for an independent engine.

Written against the given tables. The fixed values (the marks and patterns of the
quality rules) are those of the operator. Tokenizers, fingerprints of shingles,
compressed files, models and 100-byte windows are beyond SQL, or far too slow in it;
those queries are tested against plain Python.
"""

from __future__ import annotations

from assayer.llm import quality
from assayer.llm.merkle import LEAF_DIGITS, SECTION_ENDS


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _count(text: str, characters: str) -> str:
    return f"(length({text}) - length(translate({text}, {_quoted(characters)}, '')))"


def _word_characters(text: str) -> str:
    return f"length(regexp_replace({text}, '{quality.SPACE}', '', 'g'))"


# Four digits of base 32 from five of base 16.
BASE32 = """
array_to_string(list_transform(range(0, 8), lambda g:
  array_to_string(list_transform([15, 10, 5, 0], lambda s:
    substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((cast('0x' || substring(digest, g * 5 + 1, 5) as bigint) >> s) & 31) + 1, 1)), '')), '')"""

WARC = f"""
with payloads as (
  select page_id, coalesce(html, '') as html, sha1(encode(coalesce(html, ''))) as digest
  from pages
),
firsts as (select html, min(page_id) as first_id from payloads group by html)
select page_id, octet_length(encode(html)) as payload_bytes, {BASE32} as payload_digest,
  case when page_id > first_id then 'revisit' else 'response' end as record_type,
  case when page_id > first_id then first_id end as refers_to
from payloads join firsts using (html)"""

ONLY_MENU_WORDS = rf"(?i)^\W*(?:{quality.MENU_WORDS}\W*)+$"

BAD_LINE = f"""
  not regexp_matches(line, '\\p{{L}}')
  or (marks >= 3 and marks * 100 > length(line) * {quality.MOST_MARKS_PERCENT})
  or (separators >= 3 and separators * {quality.CHARACTERS_PER_SEPARATOR} >= length(line))
  or regexp_matches(line, {_quoted(ONLY_MENU_WORDS)})
  or regexp_matches(line, {_quoted(quality.BOILERPLATE)})
  or regexp_matches(line, {_quoted(quality.UNENDED)})"""

QUALITY = f"""
with docs as (
  select doc_id, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{quality.SPACE}'),
      lambda x: x <> '') as words
  from documents
),
windows as (
  select doc_id, unnest(range(1, len(words) - 1)) as i, words from docs where len(words) > 2
),
spelled as (
  select doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w from windows
),
often as (
  select doc_id, w from spelled group by doc_id, w having count(*) > 1
),
covered as (
  select distinct doc_id, unnest([i, i + 1, i + 2]) as i
  from spelled join often using (doc_id, w)
),
repeats as (select doc_id, count(*) as n from covered group by doc_id),
lines as (
  select doc_id, unnest(string_split(t, chr(10))) as line from docs
),
judged as (
  select doc_id, line, regexp_matches(line, '[^\\x20\\x09-\\x0D]') as worded,
    {_count('line', quality.MARKS)} as marks,
    {_count('line', quality.SEPARATORS)} as separators
  from lines
),
verdicts as (
  select doc_id, line, worded, worded and ({BAD_LINE}) as bad from judged
),
by_doc as (
  select doc_id, count(*) as n_lines, count(*) filter (where bad) as n_bad_lines,
    count(*) filter (where worded) - count(distinct line) filter (where worded) as n_dup_lines,
    cast(coalesce(sum({_word_characters('line')}) filter (where not bad), 0) as bigint)
      as kept_chars
  from verdicts group by doc_id
),
counted as (
  select doc_id, cast(len(words) as bigint) as n_words, {_word_characters('t')} as word_chars,
    {_count('t', quality.SYMBOLS)} as n_symbols, b.n_dup_lines,
    coalesce(r.n, 0) as n_repeat_words, b.n_lines, b.n_bad_lines, b.kept_chars
  from docs join by_doc b using (doc_id) left join repeats r using (doc_id)
),
based as (
  select *, n_words < {quality.LEAST_WORDS}
    or 100 * n_repeat_words > {quality.MOST_REPEATED_PERCENT} * n_words as base_failed
  from counted
)
select *, not base_failed
  and 100 * (word_chars - kept_chars) <= {quality.MOST_LOST_PERCENT} * word_chars as kept
from based"""

_ENDS = ", ".join(f"'{digit}'" for digit in SECTION_ENDS)

MERKLE = f"""
with pairs as (
  select doc_id, coalesce(text, '') as t,
    coalesce(lead(coalesce(text, '')) over (order by doc_id desc),
      first_value(coalesce(text, '')) over (order by doc_id desc)) as next_text,
    coalesce(lead(doc_id) over (order by doc_id desc),
      first_value(doc_id) over (order by doc_id desc)) as next_id
  from documents
),
texts as (
  select doc_id, 'own' as kind, t as x from pairs
  union all
  select doc_id, 'edited', left(t, length(t) - length(t) // 2) || left(next_text, length(t) // 2)
  from pairs
),
hashed as (
  select doc_id, kind, list_transform(string_split(x, chr(10)), lambda line:
    list_transform(string_split(regexp_replace(line, '([.,;:!?|])([ \\t])',
      '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda c: sha256(c))) as leaves
  from texts
),
paragraphs as (
  select doc_id, kind, unnest(range(1, len(leaves) + 1)) as i, leaves from hashed
),
nodes as (
  select doc_id, kind, i, sha256('p' || array_to_string(leaves[i], '')) as p from paragraphs
),
placed as (
  select doc_id, kind, i, p, coalesce(sum(case when right(p, 1) in ({_ENDS}) then 1 else 0 end)
    over (partition by doc_id, kind order by i rows between unbounded preceding
      and 1 preceding), 0) as section
  from nodes
),
sections as (
  select doc_id, kind, section, sha256('s' || string_agg(p, '' order by i)) as s
  from placed group by doc_id, kind, section
),
roots as (
  select doc_id, kind, sha256('r' || string_agg(s, '' order by section)) as root
  from sections group by doc_id, kind
),
marks as (
  select doc_id, kind,
    list_distinct(list_transform(flatten(leaves), lambda h: left(h, {LEAF_DIGITS}))) as m
  from hashed
),
changed as (
  select a.doc_id, count(distinct a.s) as n
  from sections a left join sections b
    on b.doc_id = a.doc_id and b.kind = 'edited' and b.s = a.s
  where a.kind = 'own' and b.s is null group by a.doc_id
)
select p.doc_id, length(p.t) as n_chars, sha256(e.x) as edited_sha256, r.root as fingerprint,
  q.root as edited_fingerprint,
  len(list_intersect(a.m, b.m)) / (len(a.m) + len(b.m) - len(list_intersect(a.m, b.m)))
    as near_edited,
  len(list_intersect(a.m, c.m)) / (len(a.m) + len(c.m) - len(list_intersect(a.m, c.m)))
    as near_next,
  cast(coalesce(x.n, 0) as int) as changed_sections
from pairs p
join texts e on e.doc_id = p.doc_id and e.kind = 'edited'
join roots r on r.doc_id = p.doc_id and r.kind = 'own'
join roots q on q.doc_id = p.doc_id and q.kind = 'edited'
join marks a on a.doc_id = p.doc_id and a.kind = 'own'
join marks b on b.doc_id = p.doc_id and b.kind = 'edited'
join marks c on c.doc_id = p.next_id and c.kind = 'own'
left join changed x on x.doc_id = p.doc_id"""

def _terms(text: str) -> str:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate(coalesce({text}, ''), '{capitals}', '{capitals.lower()}')"
    return f"regexp_extract_all({lowered}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"


SEARCH = f"""
with docs as (select row_number() over () as r, doc_id, {_terms("text")} as t from documents),
sized as (select r, doc_id, t, cast(len(t) as bigint) as n from docs where len(t) > 0),
corpus as (select count(*) as docs, cast(sum(n) as bigint) as terms from sized),
wanted as (
  select i, item_id, unnest(list_distinct(t)) as term
  from (select row_number() over () as i, item_id, {_terms("text")} as t from benchmark)
),
counted as (
  select r, term, count(*) as tf
  from (select r, unnest(t) as term from sized)
  where term in (select term from wanted)
  group by r, term
),
weights as (
  select term, cast(floor(1000 * ln((2 * docs + 2) / cast(2 * df + 1 as double))) as bigint) as w
  from (select term, count(*) as df from counted group by term), corpus
),
measured as (
  select r, doc_id, 100 - 90 + ((90 * n * docs) // terms) as m from sized, corpus
),
scored as (
  select i, item_id, r, doc_id,
    cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from wanted join weights using (term) join counted using (term) join measured using (r)
  group by i, item_id, r, doc_id
)
select item_id, rank, doc_id, score
from (
  select *, cast(row_number() over (
    partition by i order by score desc, doc_id asc nulls last) as int) as rank
  from scored where score > 0
)
where rank <= 10"""

ORACLE: dict[str, str] = {
    "op3_warc": WARC,
    "op5_quality_rules": QUALITY,
    "op6_merkle": MERKLE,
    "op12_lexical_search": SEARCH,
}
