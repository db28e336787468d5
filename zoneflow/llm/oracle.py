"""DuckDB SQL for the training-data queries that SQL can express."""

ORACLE: dict[str, str] = {}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op9_minhash"] = f"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') w from documents
), shingles as (
  select doc_id, unnest(case
    when len(w) >= 3 then list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2]))
    when len(w) > 0 then [w] else [] end) s
  from words
), sizes as (select doc_id, count(*) n from shingles group by 1
), pairs as (
  select a.doc_id a, b.doc_id b, count(*) c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id
  group by 1, 2
), links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 85 * (x.n + y.n - c)
), edges as (select a, b from links union all select b, a from links
), reach as (
  select doc_id a, doc_id b from documents
  union
  select reach.a, edges.b from reach join edges on reach.b = edges.a
), least as (select a doc_id, min(b) component_id from reach group by 1)
select doc_id, coalesce(n, 0) n_shingles, component_id, doc_id = component_id kept
from documents left join sizes using (doc_id) join least using (doc_id)
"""

_ALNUM = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"

ORACLE["op1_decontamination"] = f"""
with dw as (select doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) w from documents
), iw as (select item_id, regexp_extract_all({_LOWER}, {_ALNUM}) w from benchmark
), windows as (
  select item_id, unnest(case
    when len(w) >= 13 then list_transform(range(1, len(w) - 11), lambda i: w[i:i+12])
    when len(w) > 0 then [w] else [] end) s from iw
), lengths as (select distinct len(s) k from windows
), starts as (
  select doc_id, k, unnest(range(1, len(w) - k + 2)) i, w from dw, lengths where len(w) >= k
), found as (
  select doc_id, i, k, item_id from starts join windows on k = len(s) and list_slice(w, i, i + k - 1) = s
), hits as (
  select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + k)) p from found) group by 1
), items as (
  select doc_id, count(*) n_items, string_agg(id, ',' order by id) ids
  from (select distinct doc_id, cast(item_id as varchar) id from found) group by 1
)
select doc_id, cast(coalesce(len(w), 0) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(ids, '')) items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) contaminated
from dw left join hits using (doc_id) left join items using (doc_id)
"""


def _found(kind: str, number: int, pattern: str, group: int, least: int, flags: str) -> str:
    """Spans of one rule: split the text around its matches and add up the lengths."""
    return f"""
  select doc_id, '{kind}' kind, {number} number, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
    's': list_sum(list_transform(p[1:i], lambda x: length(x)))
       + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0),
    'n': length(m[i]), 'v': length(v[i])}}), recursive := true)
  from (select doc_id, regexp_extract_all(text, '{pattern}', 0, '{flags}') m,
          regexp_extract_all(text, '{pattern}', {group}, '{flags}') v,
          string_split(regexp_replace(text, '{pattern}', chr(1), 'g{flags}'), chr(1)) p from texts)
  where len(m) > 0 and v is not null"""


_RULES = [
    ("assign", """(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "i"),
    ("access", "AKIA[A-Z0-9]+", 0, 20, "c"),
    ("hex", "[0-9a-f]+", 0, 24, "c"),
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1, "c"),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1, "c"),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1, "c"),
]

ORACLE["op7_secrets"] = f"""
with texts as (select doc_id, coalesce(text, '') text from documents
), found as ({" union all ".join(_found(k, i, p, g, n, f) for i, (k, p, g, n, f) in enumerate(_RULES))}
), spans as (
  select doc_id, kind, number, cast(s as bigint) s, kind || ':' || cast(s as bigint) || ':' || cast(s + n as bigint) t
  from found where v >= case kind when 'assign' then 6 when 'access' then 20 when 'hex' then 24 else 1 end
), listed as (
  select doc_id, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access,
    count(*) filter (kind = 'hex') n_hex, string_agg(t, ',' order by s, number) filter (number < 3) base,
    string_agg(t, ',' order by s, number) spans
  from spans group by 1
)
select doc_id, coalesce(n_assign, 0) n_assign, coalesce(n_access, 0) n_access, coalesce(n_hex, 0) n_hex,
  sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from texts left join listed using (doc_id)
"""

ORACLE["op6_url_filters"] = r"""
with captures as (
  select page_id, nullif(regexp_replace(regexp_extract(lower(trim(url)),
      '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.$', ''), '') host,
    coalesce(regexp_extract(trim(url), '^[^:]+://[^/?#]*/([^/?#]+)', 1), '') step,
    date '2024-01-01' + cast(page_id % 366 as integer) fetched
  from pages
), hosts as (select host, min(page_id) m from captures where host is not null group by 1
), parents as (
  select regexp_extract(host, '([^.]+\.[^.]+)$', 1) host, min(m) m from hosts group by 1 having host <> ''
), dated as (
  select 'hosts' list, host key, true listed, m % 200 d from hosts where m % 3 = 0
  union all select 'hosts', host, false, m % 200 + 50 + m % 40 from hosts where m % 6 = 0
  union all select 'hosts', host, true, m % 200 + 80 + m % 40 from hosts where m % 30 = 0
  union all select 'domains', host, true, m % 200 + 100 from parents
  union all select 'domains', host, false, m % 200 + 120 from parents
  union all select 'paths', host || '/fr', true, m % 200 from hosts where m % 7 = 0
), valid as (
  select list, key, listed, date '2024-01-01' + cast(d as integer) a,
    date '2024-01-01' + cast(lead(d) over (partition by list, key order by d) as integer) b from dated
), active as (
  select page_id, string_agg(distinct list, ',' order by list) lists, count(*) n_active, min(a) since
  from captures join valid on listed and a <= fetched and (b is null or fetched < b)
    and (host = key or ends_with(host, '.' || key) or (step <> '' and host || '/' || step = key))
  group by 1
)
select page_id, host, cast(fetched as varchar) fetched, lists is not null blocked, coalesce(lists, '') lists,
  coalesce(n_active, 0) n_active, cast(since as varchar) listed_since
from captures left join active using (page_id)
"""

ORACLE["op8_embeddings"] = """
with recursive usable as (
  select vec_id, cast(embedding as double[]) v from embeddings
  where embedding is not null and list_count(embedding) = len(embedding)
    and len(list_filter(embedding, lambda x: not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id a, b.vec_id b from usable a join usable b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.9
), counts as (select a vec_id, count(*) n from links group by 1
), reach as (
  select vec_id a, vec_id b from embeddings
  union
  select reach.a, links.b from reach join links on reach.b = links.a
), least as (select a vec_id, min(b) component_id from reach group by 1)
select vec_id, coalesce(n, 0) n_links, component_id, vec_id = component_id kept
from embeddings left join counts using (vec_id) join least using (vec_id)
"""

ORACLE["op2_warc"] = """
with payloads as (
  select page_id, coalesce(strlen(html), 0) payload_bytes, sha1(coalesce(html, '')) payload_digest from pages
), firsts as (
  select payload_digest d, max(page_id) first_page from payloads where payload_bytes >= 1000 group by 1
)
select page_id, payload_bytes, payload_digest,
  case when page_id < first_page then 'revisit' else 'response' end record_type,
  case when page_id < first_page then first_page end refers_to
from payloads left join firsts on payload_bytes >= 1000 and payload_digest = d
"""

ORACLE["op13_exact_dedup"] = f"""
with texts as (select doc_id, {_LOWER.replace("text", "coalesce(text, '')")} t from documents
), groups as (select t, max(doc_id) keep_id, count(*) group_size from texts group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id kept, sha256(t) text_sha256 from texts join groups using (t)
"""


# ``crc.steps``: what each byte value does to a crc32, by the rule of the reflected polynomial.
_CRC = """crc as (
  select list_transform(range(256), lambda b: list_reduce(range(8), lambda v, i:
    case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end, b)) steps
)"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of ``text``, byte by byte."""
    byte = f"list_transform(range(strlen({text})), lambda i: cast('0x' || substr(hex({text}), 2 * i + 1, 2) as bigint))"
    return f"xor(list_reduce({byte}, lambda c, b: xor(c // 256, crc.steps[xor(c % 256, b) + 1]), 4294967295), 4294967295)"


def _value(column: str) -> str:
    text = f"cast({column} as varchar)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_value(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_UP = "list_transform(range((len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], '')))"

# Levels of the trees as lists of digests; ``place`` of a row is its place in the list of its level.
ORACLE["op11_manifest"] = f"""
with recursive {_CRC}, marked as (
  select *, row_number() over (partition by source order by doc_id) - 1 pos, {_crc32("cast(doc_id as varchar)")} h
  from documents, crc
), leaves as (
  select doc_id, source, pos, {_leaf("text")} leaf,
    case when h % 2 = 0 then {_leaf("replace(text, chr(10), '')")} else {_leaf("text")} end seen
  from marked
), levels as (
  select source, 0 level, list(leaf order by pos) nodes from leaves group by source
  union all
  select source, level + 1, {_UP} from levels where len(nodes) > 1
), subroots as (
  select source, nodes[1] subroot, level height, row_number() over (order by source nulls first) - 1 pos
  from levels where len(nodes) = 1
), tops as (
  select 0 level, list(subroot order by pos) nodes from subroots
  union all
  select level + 1, {_UP} from tops where len(nodes) > 1
), folded as (
  select doc_id, source, 0 step, pos, seen digest, '' siblings, false above from leaves
  union all
  select f.doc_id, f.source, f.step + 1, f.pos // 3,
    sha256(array_to_string(list_transform(n.run, lambda x, i: case when i = f.pos % 3 + 1 then f.digest else x end), '')),
    f.siblings || array_to_string(list_transform(n.run, lambda x, i: case when i = f.pos % 3 + 1 then '' else x end), ''),
    f.above
  from (
    select f.doc_id, f.source, f.step, case when not f.above and f.step = s.height then s.pos else f.pos end pos, f.digest,
      f.siblings, f.above or f.step = s.height above, s.height
    from folded f join subroots s on f.source is not distinct from s.source
  ) f join (
    select source, false above, level, nodes from levels
    union all select s.source, true, s.height + t.level, t.nodes from subroots s, tops t
  ) l on l.source is not distinct from f.source and l.above = f.above and l.level = f.step and len(l.nodes) > 1,
  lateral (select l.nodes[f.pos - f.pos % 3 + 1:f.pos - f.pos % 3 + 3] run) n
), lasts as (select doc_id, source, arg_max(digest, step) folded_root, arg_max(siblings, step) siblings from folded group by all)
select l.doc_id, leaf, subroot, root, sha256(siblings) proof_sha256, folded_root, folded_root = root verified
from leaves l join lasts on l.doc_id = lasts.doc_id join subroots s on s.source is not distinct from l.source,
  (select nodes[1] root from tops where len(nodes) = 1)
"""

ORACLE["op12_spelling"] = f"""
with recursive {_CRC}, found as (
  select cast(doc_id as varchar) id, unnest(regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]+')) r from documents
), runs as (select id, r, count(*) n from found where length(r) >= 7 group by all
), hashed as (select *, coalesce({_crc32("(id || ':' || r)")}, 1) h from runs, crc
), cut as (
  select case when h % 31 = 0 then r[:h % length(r)] || r[h % length(r) + 2:] else r end word, n from hashed
), vocabulary as (
  select word, cast(sum(n) as bigint) n from cut where length(word) >= 7 group by 1 having sum(n) >= 2
), less as (
  select word, n, i, word[:i] || word[i + 2:] rest from (select *, unnest(range(length(word))) i from vocabulary)
), near as (
  select distinct a.word a, b.word b, b.n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union
  select less.word, v.word, v.n from less join vocabulary v on less.rest = v.word
  union
  select v.word, less.word, less.n from less join vocabulary v on less.rest = v.word
), best as (
  select a word, count(*) n_near, arg_min({{'w': b, 'n': n}}, {{'m': -n, 'w': encode(b)}}) f from near group by 1
), forms as (
  select word, n, coalesce(n_near, 0) n_near, case when f.n >= 10 * n then f.w end form,
    case when f.n >= 10 * n then f.n end form_n
  from vocabulary left join best using (word)
), follow as (
  select word, coalesce(form, word) root, form is null done from forms
  union all
  select follow.word, coalesce(f.form, f.word), f.form is null from follow join forms f on follow.root = f.word where not done
)
select forms.*, root from forms join follow using (word) where done
"""
