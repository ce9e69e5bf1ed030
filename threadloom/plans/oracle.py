"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code as plain SQL over the driver's
views. Shared pieces (the post stand-ins, the html token table) are CTE
builders so that every query states its whole computation.
"""

from __future__ import annotations

from html.entities import html5

from threadloom.functions.text import PY_WHITESPACE
from threadloom.sources.tables import SITE_SOURCES, WROTE_MARKER

ORACLE: dict[str, str] = {}

# Tags and texts of a page, as this file reads them: its engine takes time in proportion to the page.
TOKEN_PATTERN = r"""<[A-Za-z/!?]([^>"']|"[^"]*"|'[^']*')*>|[^<]+|<"""
A_TAG_PATTERN = r"""(?i)<a\s([^>"']|"[^"]*"|'[^']*')*>"""
TAG_START = "^<[A-Za-z/!?]"
VOID_TAGS = "area base br col embed hr img input link meta param source track wbr".split()


def _chr_concat(chars: str) -> str:
    return "||".join(f"chr({ord(c)})" for c in chars)


WS = _chr_concat(PY_WHITESPACE)
MAP_FROM = _chr_concat(" \n\t\r")
# RE2 has no lookahead; on whitespace-mapped text the plain \s+ branch
# yields the same count.
PRETOKEN_RE2 = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def c1(x: str) -> str:
    return f"translate({x}, {MAP_FROM}, '   ')"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def clean(x: str) -> str:
    return strip(c1(x))


def tokens(x: str) -> str:
    return f"len(regexp_extract_all({c1(x)}, {sql_str(PRETOKEN_RE2)}))"


def lcode(x: str) -> str:
    n = tokens(x)
    return f"(CASE WHEN {n} <= 15 THEN '1' WHEN {n} <= 50 THEN '2' WHEN {n} <= 256 THEN '3' ELSE '-' END)"


def esc(x: str) -> str:
    return f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&#34;'), chr(223), '&#xDF;')"


def hexd(x: str) -> str:
    return f"substr(md5({x}), 1, 1)"


# --------------------------------------------------------------------------
# stand-in posts
# --------------------------------------------------------------------------
def conv_posts_cte(name: str = "posts") -> str:
    a, b, c, d = SITE_SOURCES
    tid = "CAST(conv_id AS VARCHAR)"
    bt = "CASE WHEN left_open THEN '<b>' ELSE '' END"
    q, r, qa = esc("coalesce(prev_text, '')"), esc("coalesce(text, '')"), "coalesce(prev_role, '')"
    return f"""
{name}_src AS (
  SELECT conv_id, turn, role, text,
         lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_text,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prev_role,
         CASE WHEN {hexd(tid)} IN ('0','1','2','3') THEN '{a}'
              WHEN {hexd(tid)} IN ('4','5','6','7') THEN '{b}'
              WHEN {hexd(tid)} IN ('8','9','a','b') THEN '{c}' ELSE '{d}' END AS source
  FROM conversations
),
{name}_q AS (
  SELECT *, (turn > 0 AND prev_text IS NOT NULL
             AND {hexd(tid + " || ':' || CAST(turn AS VARCHAR)")} IN ('0','1','2','3','4')) AS is_quote,
         substr(md5({tid} || ':' || CAST(turn AS VARCHAR)), 2, 1) IN ('0','1','2','3') AS left_open
  FROM {name}_src
),
{name} AS (
  SELECT source, {tid} AS topic_id,
    CASE source WHEN '{a}' THEN 'https://psy.su/club/forum/topic/' || {tid} || '/'
                WHEN '{b}' THEN 'https://www.b17.ru/forum/topic.php?id=' || {tid}
                WHEN '{c}' THEN 'https://psycheforum.ru/topic/' || {tid} || '-t/'
                ELSE 'https://psyhelp24.org/psihologicheskaya-konsultatsiya-' || {tid} || '/' END AS url,
    role AS author_id, role AS author_name, text,
    CASE WHEN source = '{a}' AND is_quote THEN '<div class="text"><div class="forum_quote"><div class="quote">' || {bt} || {q} || '</div></div>' || {r} || '</div>'
         WHEN source = '{a}' THEN '<div class="text">' || {r} || '</div>'
         WHEN source = '{b}' AND is_quote THEN '<td class="mes qq"><div class="quote"><b>' || {qa} || ' {WROTE_MARKER}:</b>' || {bt} || {q} || '</div>' || {r} || '</td>'
         WHEN source = '{b}' THEN '<td class="mes qq">' || {r} || '</td>'
         WHEN source = '{c}' AND is_quote THEN '<div data-role="commentContent"><blockquote><p>' || {q} || CASE WHEN left_open THEN '' ELSE '</p>' END || '</blockquote><p>' || {r} || '</p></div>'
         WHEN source = '{c}' THEN '<div data-role="commentContent"><p>' || {r} || '</p></div>'
         ELSE '<p>' || {r} || '</p>' END AS html,
    CAST(turn AS BIGINT) AS pos
  FROM {name}_q
)"""


def doc_posts_cte(name: str = "posts", topic_size: int = 25) -> str:
    tid = f"CAST(CAST(floor(doc_id / {topic_size}) AS BIGINT) AS VARCHAR)"
    return f"""
{name} AS (
  SELECT 'documents' AS source, {tid} AS topic_id, 'https://docs.example/topic/' || {tid} AS url,
         source AS author_id, source AS author_name, text,
         '<p>' || {esc("coalesce(text, '')")} || '</p>' AS html, CAST(doc_id AS BIGINT) AS pos
  FROM documents
)"""


# --------------------------------------------------------------------------
# html token table with ancestors (same algorithm as html_tokens)
# --------------------------------------------------------------------------
DROP_RE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"


def _reference_map() -> str:
    """The standard's table of names (its bare ones too) as a map."""
    names = sorted(html5)
    return f"MAP([{', '.join(map(sql_str, names))}], [{', '.join(sql_str(html5[n]) for n in names)}])"


_REF = _reference_map()
_BARE = "^(" + "|".join(sorted((n for n in html5 if n[-1] != ";"), key=len, reverse=True)) + ")"
_C1 = "[" + ", ".join(f"chr({ord(bytes([b]).decode('cp1252', 'ignore') or chr(b))})" for b in range(128, 160)) + "]"


def _decode(x: str, attribute: bool = False) -> str:
    digits = "regexp_extract(p, '^&#[xX]?0*([0-9a-fA-F]*);?$', 1)"
    code = (f"CASE WHEN len({digits}) > 7 THEN 1114112 WHEN {digits} = '' THEN 0 WHEN regexp_matches(p, '^&#[xX]') THEN CAST('0x' || {digits} AS BIGINT) "
            f"ELSE CAST({digits} AS BIGINT) END")
    char = (f"list_transform([{code}], lambda c: CASE WHEN c = 0 OR c > 1114111 OR c BETWEEN 55296 AND 57343 THEN chr(65533) "
            f"WHEN c BETWEEN 128 AND 159 THEN {_C1}[c - 127] ELSE chr(CAST(c AS INTEGER)) END)[1]")
    bare = f"regexp_extract(p, {sql_str('^&' + _BARE[1:])}, 1)"
    rest = f"substr(p, 2 + len({bare}))"
    begins = f"{bare} <> ''" + (f" AND {rest} = ''" if attribute else "")
    return f"""CASE WHEN strpos({x}, '&') > 0 THEN array_to_string(list_transform(
      regexp_extract_all({x}, '&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*[;=]?|[^&]+|&'),
      lambda p: CASE WHEN p NOT LIKE '&_%' THEN p WHEN p LIKE '&#%' THEN {char}
                     ELSE coalesce({_REF}[substr(p, 2)], CASE WHEN {begins} THEN {_REF}[{bare}] || {rest} END, p) END), '') ELSE {x} END"""


def _attr(name: str, expr: str = "tok") -> str:
    from threadloom.operators.html_tokens import attr_pattern
    pat = sql_str(attr_pattern(name))
    return f"(regexp_extract({expr}, {pat}, 1) || regexp_extract({expr}, {pat}, 2) || regexp_extract({expr}, {pat}, 3))"


def token_ctes(src: str, key: list[str], keep: list[str], name: str = "tok", ancestors: int = 2,
               count_tags: tuple[str, ...] | None = None, html: str = "html") -> str:
    k = ", ".join(key)
    kp = ", ".join(keep)
    kk = ", ".join(key + keep)
    void = ", ".join(sql_str(t) for t in VOID_TAGS)
    if count_tags:
        counted = f"tag IN ({', '.join(sql_str(t) for t in count_tags)})"
    else:
        counted = f"tag NOT IN ({void})"
    counted = f"({counted} AND tag <> '')"
    repair = count_tags is None
    shifts = "[" + ", ".join(str(i) for i in range(ancestors + 1)) + "]"
    desc = "{'tpos': tpos, 'tag': tag, 'cls': cls, 'eid': eid, 'role': role}"
    ancs = ",\n".join(
        f"    last_value(CASE WHEN is_elem AND sh = {r} THEN {desc} END IGNORE NULLS) OVER wl AS anc{r}"
        for r in range(ancestors + 1))
    return f"""
{name}_0 AS (
  SELECT {kk}, u.tok, CAST(u.i - 1 AS INTEGER) AS tpos
  FROM {src}, unnest(regexp_extract_all(regexp_replace({html}, {sql_str(DROP_RE)}, '', 'g'),
                                          {sql_str(TOKEN_PATTERN)})) WITH ORDINALITY AS u(tok, i)
),
{name}_1 AS (
  SELECT *, CASE WHEN NOT regexp_matches(tok, {sql_str(TAG_START)}) THEN 'text' WHEN tok LIKE '</%' THEN 'close'
                 WHEN regexp_matches(tok, '^<[A-Za-z]') THEN 'open' ELSE 'other' END AS kind,
            CASE WHEN regexp_matches(tok, {sql_str(TAG_START)}) THEN lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) ELSE '' END AS tag
  FROM {name}_0
),
{_match_ctes(name, k, counted, repair)},
{name}_2 AS (
  SELECT *, CASE WHEN kind = 'open' THEN {_attr('class')} ELSE '' END AS cls,
            CASE WHEN kind = 'open' THEN {_attr('id')} ELSE '' END AS eid,
            CASE WHEN kind = 'open' THEN {_attr('data-role')} ELSE '' END AS role,
            CASE WHEN kind = 'text' THEN {_decode('tok')} END AS text,
  FROM {name}_1m
),
{name}_3 AS (
  SELECT *, sum(delta) OVER (PARTITION BY {k} ORDER BY tpos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS d_after
  FROM {name}_2
),
{name}_4 AS (
  SELECT *, d_after - delta AS d_before,
         CASE WHEN kind = 'open' AND delta = 1 THEN d_after ELSE d_after - delta END AS lvl,
         (kind = 'open' AND delta = 1) AS is_elem
  FROM {name}_3
),
{name}_5 AS (
  SELECT *, unnest(CASE WHEN is_elem THEN {shifts} ELSE [0] END) AS sh FROM {name}_4
),
{name}_6 AS (
  SELECT *, lvl + sh AS akey FROM {name}_5
),
{name} AS (
  SELECT * EXCLUDE (sh, akey) FROM (
  SELECT *,
{ancs}
  FROM {name}_6
  WINDOW wl AS (PARTITION BY {k}, akey ORDER BY tpos, sh DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  ) WHERE sh = 0
)"""


def _match_ctes(name: str, k: str, counted: str, repair: bool) -> str:
    """Tags matched by name; with ``repair`` unclosed blocks, p and li get close rows."""
    inline = "tag IN ('a','abbr','b','big','cite','code','em','font','i','mark','s','small','span','strike','strong','sub','sup','tt','u')"
    soft = f"({inline} OR tag IN ('p', 'li'))"
    up, down = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    w_name, w_doc = f"PARTITION BY {k}, tag ORDER BY tpos", f"PARTITION BY {k} ORDER BY tpos"
    stray = f"sign = -1 AND mm < lag(mm, 1, 0) OVER ({w_name})"
    loose = f"sign = 1 AND coalesce(min(dd) OVER ({w_name} {down}), dd) >= dd"
    if repair:
        stray = f"CASE WHEN tag = 'p' THEN sign = -1 AND coalesce(lag(sign) OVER ({w_name}), -1) = -1 ELSE {stray} END"
        loose = f"CASE WHEN tag = 'p' THEN sign = 1 AND coalesce(lead(sign) OVER ({w_name}), 1) = 1 ELSE {loose} END"
    base = f"""{name}_ma AS (
  SELECT *, CASE WHEN kind = 'open' AND {counted} THEN 1 WHEN kind = 'close' AND {counted} THEN -1 ELSE 0 END AS sign FROM {name}_1
),
{name}_mb AS (SELECT *, sum(sign) OVER ({w_name} {up}) AS ss FROM {name}_ma),
{name}_mc AS (SELECT *, least(0, min(ss) OVER ({w_name} {up})) AS mm FROM {name}_mb),
{name}_md AS (SELECT *, ss - mm AS dd FROM {name}_mc),
{name}_me AS (SELECT *, sign <> 0 AND NOT ({stray}) AND NOT ({loose}) AS firm FROM {name}_md)"""
    if not repair:
        return base + f""",
{name}_1m AS (SELECT * EXCLUDE (tpos, sign, ss, mm, dd, firm), CASE WHEN firm THEN sign ELSE 0 END AS delta, CAST(tpos AS BIGINT) * 1048576 AS tpos FROM {name}_me)"""
    return base + f""",
{name}_mf AS (
  SELECT *, sum(CASE WHEN firm AND NOT {soft} THEN sign ELSE 0 END) OVER ({w_doc} {up}) AS cd,
         CASE WHEN tag = 'p' THEN 0 WHEN sign = 1 THEN dd ELSE dd + 1 END AS lv FROM {name}_me
),
{name}_mg AS (
  SELECT * EXCLUDE (firm), firm AND NOT coalesce({soft} AND cd <> CASE WHEN sign = 1 THEN lead(cd) OVER wp ELSE lag(cd) OVER wp END, false) AS firm
  FROM {name}_mf WINDOW wp AS (PARTITION BY {k}, tag, firm, lv ORDER BY tpos)
),
{name}_mh AS (SELECT *, CASE WHEN firm THEN sign ELSE 0 END AS delta0, sign = 1 AND NOT firm AND NOT {inline} AS hangs FROM {name}_mg),
{name}_mi AS (SELECT *, sum(delta0) OVER ({w_doc} {up}) AS df FROM {name}_mh),
{name}_mj AS (SELECT *, CASE WHEN delta0 = -1 THEN df + 1 ELSE df END AS lev FROM {name}_mi),
{name}_mk AS (
  SELECT *, CASE WHEN hangs THEN least(
    coalesce(first_value(CASE WHEN delta0 = -1 THEN tpos END IGNORE NULLS) OVER (PARTITION BY {k}, lev ORDER BY tpos {down}), 1073741824),
    coalesce(CASE WHEN tag = 'p' THEN first_value(CASE WHEN sign = 1 AND NOT {inline} THEN tpos END IGNORE NULLS) OVER ({w_doc} {down})
                  WHEN tag = 'li' THEN first_value(CASE WHEN sign = 1 THEN tpos END IGNORE NULLS) OVER (PARTITION BY {k}, lev, tag ORDER BY tpos {down}) END,
             1073741824)) END AS ends FROM {name}_mj
),
{name}_ml AS (SELECT *, row_number() OVER (PARTITION BY {k}, ends ORDER BY tpos) AS nth FROM {name}_mk),
{name}_mm AS (SELECT *, unnest(CASE WHEN hangs THEN [0, 1] ELSE [0] END) AS made FROM {name}_ml),
{name}_1m AS (
  SELECT * EXCLUDE (tpos, kind, tok, sign, ss, mm, dd, firm, cd, lv, delta0, hangs, df, lev, ends, nth, made),
         CASE WHEN made = 1 THEN -1 WHEN hangs THEN 1 ELSE delta0 END AS delta, CASE WHEN made = 1 THEN 'close' ELSE kind END AS kind,
         CASE WHEN made = 1 THEN '' ELSE tok END AS tok,
         CASE WHEN made = 1 THEN CAST(ends AS BIGINT) * 1048576 - nth ELSE CAST(tpos AS BIGINT) * 1048576 END AS tpos
  FROM {name}_mm)"""


def _pred(d: str, tag: str, cls: str | None = None, role: str | None = None, eid: str | None = None) -> str:
    c = f"coalesce({d}.tag = '{tag}'"
    for one in (cls or "").split():
        c += f" AND list_contains(regexp_split_to_array({d}.cls, '\\s+'), {sql_str(one)})"
    if role is not None:
        c += f" AND {d}.role = {sql_str(role)}"
    if eid is not None:
        c += f" AND {d}.eid = {sql_str(eid)}"
    return c + ", false)"


def _inside(pred_anc0: str, k: str) -> str:
    step = (f"CASE WHEN is_elem AND {pred_anc0} THEN 1 "
            f"WHEN kind = 'close' AND delta = -1 AND {pred_anc0} THEN -1 ELSE 0 END")
    return (f"(sum({step}) OVER (PARTITION BY {k} ORDER BY tpos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            f" - CASE WHEN is_elem AND {pred_anc0} THEN 1 ELSE 0 END)")


POST_KEY = ["source", "topic_id", "pos"]


def quote_pairs_ctes(posts: str = "posts", name: str = "qpairs") -> str:
    k = ", ".join(POST_KEY)
    a_quote = (f"(kind = 'text' AND {_pred('anc0', 'div', 'quote')} AND {_pred('anc1', 'div', 'forum_quote')}"
               f" AND {_pred('anc2', 'div', 'text')})")
    a_reply = f"(kind = 'text' AND {_pred('anc0', 'div', 'text')})"
    b_top = f"(is_elem AND {_pred('anc0', 'div', 'quote')} AND {_pred('anc1', 'td', 'mes qq')})"
    c_top = (f"(is_elem AND {_pred('anc0', 'blockquote')} AND "
             f"{_pred('anc1', 'div', role='commentContent')})")
    w = f"(PARTITION BY {k} ORDER BY tpos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    marker = sql_str(WROTE_MARKER)
    return f"""
{name}_in AS (
  SELECT {k}, CASE WHEN strpos(url, 'psy.su') > 0 THEN 'a' WHEN strpos(url, 'b17.ru') > 0 THEN 'b'
                   WHEN strpos(url, 'psycheforum.ru') > 0 THEN 'c' END AS rule, html
  FROM {posts}
),
{name}_in2 AS (SELECT * FROM {name}_in WHERE rule IS NOT NULL),
{token_ctes(name + "_in2", POST_KEY, ["rule"], name=name + "_t", ancestors=2)},
{name}_f AS (
  SELECT *, {a_quote} AS a_quote, {a_reply} AS a_reply, {b_top} AS b_top_open, {c_top} AS c_top_open,
         {_inside(_pred('anc0', 'td', 'mes qq'), k)} AS in_b_body,
         {_inside(_pred('anc0', 'div', role='commentContent'), k)} AS in_c_body,
         {_inside(_pred('anc0', 'p'), k)} AS in_p,
         {strip('text')} AS stext
  FROM {name}_t
),
{name}_f2 AS (
  SELECT *, last_value(CASE WHEN b_top_open THEN tpos END IGNORE NULLS) OVER {w} AS b_top_pos,
            last_value(CASE WHEN c_top_open THEN tpos END IGNORE NULLS) OVER {w} AS c_top_pos
  FROM {name}_f
),
{name}_tok AS (
  SELECT *,
    last_value(CASE WHEN b_top_open THEN tpos WHEN kind = 'close' AND delta = -1 AND anc0.tpos = b_top_pos THEN -1 END
               IGNORE NULLS) OVER {w} AS b_qid,
    last_value(CASE WHEN c_top_open THEN tpos WHEN kind = 'close' AND delta = -1 AND anc0.tpos = c_top_pos THEN -1 END
               IGNORE NULLS) OVER {w} AS c_qid
  FROM {name}_f2
),
{name}_ag AS (
  SELECT {k}, list(text ORDER BY tpos) FILTER (WHERE a_quote) AS q, list(text ORDER BY tpos) FILTER (WHERE a_reply) AS r
  FROM {name}_tok WHERE rule = 'a' GROUP BY {k}
),
{name}_ag2 AS (
  SELECT {k}, q, CASE WHEN len(r) > len(q) AND {strip('r[1]')} = '' THEN r[2:] ELSE r END AS r
  FROM {name}_ag WHERE len(q) > 0 AND len(r) > 0
),
{name}_a AS (
  SELECT {k}, 'a' AS rule, CAST(kk AS BIGINT) AS k, {clean('q[kk + 1]')} AS speaker0_text, {clean('r[kk + 1]')} AS speaker1_text
  FROM (SELECT *, unnest(range(least(len(q), len(r)))) AS kk FROM {name}_ag2)
),
{name}_bbody AS (
  SELECT {k}, coalesce(list(stext ORDER BY tpos) FILTER (WHERE kind = 'text' AND in_b_body > 0 AND stext <> ''), []) AS text_all
  FROM {name}_tok WHERE rule = 'b' GROUP BY {k}
),
{name}_bq AS (
  SELECT {k}, b_qid, list(stext ORDER BY tpos) AS frags
  FROM {name}_tok
  WHERE rule = 'b' AND kind = 'text' AND b_qid >= 0 AND stext <> '' AND strpos(stext, {marker}) = 0
  GROUP BY {k}, b_qid
),
{name}_bj AS (
  SELECT q.*, b.text_all, list_slice(b.text_all, list_position(b.text_all, q.frags[-1]) + 1, len(b.text_all)) AS tail
  FROM {name}_bq q JOIN {name}_bbody b USING ({k})
),
{name}_b AS (
  SELECT {k}, 'b' AS rule, CAST(row_number() OVER (PARTITION BY {k} ORDER BY b_qid) - 1 AS BIGINT) AS k,
         {clean("array_to_string(frags, chr(10))")} AS speaker0_text,
         {clean("array_to_string(CASE WHEN m IS NULL THEN tail ELSE list_slice(tail, 1, m - 1) END, chr(10))")} AS speaker1_text
  FROM (SELECT *, list_position(list_transform(tail, lambda x: strpos(x, {marker}) > 0), true) AS m FROM {name}_bj)
),
{name}_cbody AS (
  SELECT {k}, coalesce(list(stext ORDER BY tpos) FILTER (WHERE kind = 'text' AND in_c_body > 0 AND in_p > 0 AND stext <> ''), []) AS text_all
  FROM {name}_tok WHERE rule = 'c' GROUP BY {k}
),
{name}_ctops AS (SELECT {k}, tpos AS c_qid FROM {name}_tok WHERE rule = 'c' AND c_top_open),
{name}_cfr AS (
  SELECT {k}, c_qid, list(stext ORDER BY tpos) AS frags
  FROM {name}_tok WHERE rule = 'c' AND kind = 'text' AND c_qid >= 0 AND in_p > 0 AND stext <> ''
  GROUP BY {k}, c_qid
),
{name}_cq AS (
  SELECT t.{k.replace(', ', ', t.')}, t.c_qid, f.frags,
         lead(f.frags[1]) OVER (PARTITION BY t.{k.replace(', ', ', t.')} ORDER BY t.c_qid) AS next_first
  FROM {name}_ctops t LEFT JOIN {name}_cfr f USING ({k}, c_qid)
),
{name}_cj AS (
  SELECT q.*, b.text_all,
         list_position(list_transform(b.text_all, lambda x: strpos(x, q.frags[-1]) > 0), true) AS p
  FROM {name}_cq q JOIN {name}_cbody b USING ({k})
  WHERE len(coalesce(q.frags, [])) > 0
),
{name}_cj2 AS (
  SELECT *, list_slice(text_all, p + 1, len(text_all)) AS tail FROM {name}_cj
  WHERE p IS NOT NULL AND p < len(text_all)
),
{name}_c AS (
  SELECT {k}, 'c' AS rule, CAST(row_number() OVER (PARTITION BY {k} ORDER BY c_qid) - 1 AS BIGINT) AS k,
         {clean("array_to_string(frags, chr(10))")} AS speaker0_text,
         {clean("array_to_string(CASE WHEN e IS NULL THEN tail ELSE list_slice(tail, 1, e - 1) END, chr(10))")} AS speaker1_text
  FROM (SELECT *, list_position(tail, next_first) AS e FROM {name}_cj2)
),
{name} AS (
  SELECT * FROM {name}_a UNION ALL SELECT * FROM {name}_b UNION ALL SELECT * FROM {name}_c
)"""


def chain_ctes(posts: str = "posts", qpairs: str | None = "qpairs", name: str = "chain",
               max_answers: int = 5, tail: bool = False) -> str:
    t = "source, topic_id"
    emit = "coalesce(q.emit_pos, 9223372036854775807)" if tail else "q.emit_pos"
    qjoin = (f"LEFT JOIN (SELECT DISTINCT source, topic_id, pos, true AS is_quote FROM {qpairs}) qk USING (source, topic_id, pos)"
             if qpairs else "")
    isq = "coalesce(qk.is_quote, false)" if qpairs else "false"
    return f"""
{name}_p AS (
  SELECT p.source, p.topic_id, p.pos, p.author_id, p.text, {isq} AS is_quote,
         row_number() OVER wt = 1 AS is_first, first_value(p.author_id) OVER wt AS starter
  FROM {posts} p {qjoin}
  WINDOW wt AS (PARTITION BY p.source, p.topic_id ORDER BY p.pos)
),
{name}_c AS (
  SELECT *, is_first OR coalesce(author_id = starter, false) AS iss
  FROM {name}_p WHERE is_first OR (NOT is_quote AND text IS NOT NULL AND text <> '')
),
{name}_s AS (
  SELECT *, sum(brk) OVER (PARTITION BY {t} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seg,
         CASE WHEN is_first THEN {strip("coalesce(text, '')")} ELSE {clean('text')} END AS ctext
  FROM (SELECT *, CASE WHEN iss AND NOT is_first AND NOT lag(iss) OVER (PARTITION BY {t} ORDER BY pos) THEN 1 ELSE 0 END AS brk
        FROM {name}_c)
),
{name}_q AS (
  SELECT *, lead(seg_start) OVER (PARTITION BY {t} ORDER BY seg) AS emit_pos FROM (
    SELECT {t}, seg, min(pos) AS seg_start, string_agg(ctext, '' ORDER BY pos) AS question
    FROM {name}_s WHERE iss GROUP BY {t}, seg)
),
{name}_a AS (
  SELECT *, row_number() OVER (PARTITION BY {t}, seg ORDER BY first_pos) - 1 AS answer_k FROM (
    SELECT {t}, seg, author_id, min(pos) AS first_pos,
           coalesce(arg_min(ctext, pos) FILTER (WHERE ctext <> ''), '') AS answer
    FROM {name}_s WHERE NOT iss GROUP BY {t}, seg, author_id)
),
{name} AS (
  SELECT q.source, q.topic_id, CAST({emit} AS BIGINT) AS emit_pos, CAST(a.answer_k AS BIGINT) AS emit_k,
         'chain' AS kind, q.question AS speaker0_text, a.answer AS speaker1_text
  FROM {name}_q q JOIN {name}_a a USING ({t}, seg)
  WHERE {'true' if tail else 'q.emit_pos IS NOT NULL'} AND a.answer_k < {max_answers}
)"""


def quote_dialog_cte(posts: str = "posts", qpairs: str = "qpairs", name: str = "qdialog") -> str:
    return f"""
{name} AS (
  SELECT q.source, q.topic_id, CAST(q.pos AS BIGINT) AS emit_pos, CAST(q.k AS BIGINT) AS emit_k, 'quote' AS kind,
         q.speaker0_text, q.speaker1_text
  FROM {qpairs} q JOIN (SELECT source, topic_id, min(pos) AS first_pos FROM {posts} GROUP BY source, topic_id) f
       USING (source, topic_id)
  WHERE q.pos <> f.first_pos
)"""


def encode_select(src: str) -> str:
    return (f"SELECT *, {lcode('speaker0_text')} AS len0, {lcode('speaker1_text')} AS len1, "
            f"'|0|' || {lcode('speaker0_text')} || '|' || speaker0_text || '|1|' || {lcode('speaker1_text')} "
            f"|| '|' || speaker1_text AS line FROM {src}")


def two_speaker_ctes(posts: str = "posts", name: str = "v1") -> str:
    t = "source, topic_id"
    return f"""
{name}_p AS (SELECT {t}, pos, author_id, text FROM {posts} WHERE text IS NOT NULL),
{name}_f AS (
  SELECT *, row_number() OVER (PARTITION BY {t} ORDER BY first_pos) AS rk
  FROM (SELECT {t}, author_id, min(pos) AS first_pos FROM {name}_p GROUP BY {t}, author_id)
),
{name}_sp AS (
  SELECT {t}, max(CASE WHEN rk = 1 THEN {{'a': author_id}} END).a AS speaker0,
              max(CASE WHEN rk = 2 THEN {{'a': author_id}} END).a AS speaker1
  FROM {name}_f WHERE rk <= 2 GROUP BY {t}
),
{name}_j AS (
  SELECT p.*, CASE WHEN p.author_id IS NOT DISTINCT FROM s.speaker0 THEN 0 ELSE 1 END AS spk
  FROM {name}_p p JOIN {name}_sp s USING ({t})
  WHERE s.speaker1 IS NOT NULL AND (p.author_id IS NOT DISTINCT FROM s.speaker0 OR p.author_id = s.speaker1)
),
{name}_r AS (
  SELECT *, sum(chg) OVER (PARTITION BY {t} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS run
  FROM (SELECT *, CASE WHEN coalesce(spk <> lag(spk) OVER (PARTITION BY {t} ORDER BY pos), true) THEN 1 ELSE 0 END AS chg
        FROM {name}_j)
),
{name}_runs AS (
  SELECT {t}, run, min(pos) AS run_pos,
         list_reduce(list_prepend('', list({c1('text')} ORDER BY pos)),
                     lambda acc, x: CASE WHEN acc = '' THEN x ELSE acc || ' ' || x END) AS run_text
  FROM {name}_r GROUP BY {t}, run
),
{name} AS (
  SELECT {t}, CAST(coalesce(after_next, 9223372036854775807) AS BIGINT) AS emit_pos, CAST(run // 2 AS BIGINT) AS emit_k, 'two_speaker' AS kind,
         run_text AS speaker0_text, next_text AS speaker1_text
  FROM (SELECT *, lead(run_text) OVER w AS next_text, lead(run_pos, 2) OVER w AS after_next
        FROM {name}_runs WINDOW w AS (PARTITION BY {t} ORDER BY run))
  WHERE run % 2 = 0 AND next_text IS NOT NULL AND (after_next IS NOT NULL OR next_text <> '')
)"""


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


ORACLE["dialog_dataset"] = with_(
    conv_posts_cte(), quote_pairs_ctes(), chain_ctes(), quote_dialog_cte(),
    "pairs AS (SELECT * FROM chain UNION ALL SELECT * FROM qdialog)",
    select=encode_select("pairs"))
ORACLE["dialog_starter_chain"] = with_(conv_posts_cte(), quote_pairs_ctes(), chain_ctes(),
                                       select="SELECT * FROM chain")
ORACLE["dialog_starter_chain_docs"] = with_(doc_posts_cte(), chain_ctes(qpairs=None), select="SELECT * FROM chain")
ORACLE["quote_pairs"] = with_(conv_posts_cte(), quote_pairs_ctes(), select="SELECT * FROM qpairs")
ORACLE["dialog_two_speaker"] = with_(conv_posts_cte(), two_speaker_ctes(), select="SELECT * FROM v1")
ORACLE["dialog_two_speaker_docs"] = with_(doc_posts_cte(), two_speaker_ctes(), select="SELECT * FROM v1")


# --------------------------------------------------------------------------
# chain steps
# --------------------------------------------------------------------------
CONV = conv_posts_cte()
DOCS = doc_posts_cte()
QP = quote_pairs_ctes()
DK = "source, topic_id, emit_pos, emit_k, kind"
PAIRS = "pairs AS (SELECT * FROM chain UNION ALL SELECT * FROM qdialog)"
LINES = f"lines AS (SELECT {DK}, line FROM ({encode_select('pairs')}))"

ORACLE["first_two_speakers"] = with_(CONV, two_speaker_ctes(),
                                     select="SELECT source, topic_id, speaker0, speaker1 FROM v1_sp")
ORACLE["speaker_runs"] = with_(CONV, two_speaker_ctes(), select="""
SELECT r.source, r.topic_id, CAST(r.run AS BIGINT) AS run, CAST(s.spk AS BIGINT) AS spk, r.run_pos, r.run_text
FROM v1_runs r JOIN (SELECT DISTINCT source, topic_id, run, spk FROM v1_r) s USING (source, topic_id, run)""")
ORACLE["topic_starter"] = with_(CONV, select="""
SELECT source, topic_id, pos AS first_pos, author_id AS starter FROM (
  SELECT *, row_number() OVER (PARTITION BY source, topic_id ORDER BY pos) AS rn FROM posts) WHERE rn = 1""")
ORACLE["chain_segments"] = with_(CONV, QP, chain_ctes(), select="""
SELECT source, topic_id, pos, iss, CAST(seg AS BIGINT) AS seg, ctext FROM chain_s""")
ORACLE["segment_question"] = with_(CONV, QP, chain_ctes(), select="""
SELECT source, topic_id, CAST(seg AS BIGINT) AS seg, seg_start, question FROM chain_q""")
ORACLE["first_answers"] = with_(DOCS, chain_ctes(qpairs=None), select="""
SELECT source, topic_id, CAST(seg AS BIGINT) AS seg, author_id, first_pos, answer, CAST(answer_k AS BIGINT) AS answer_k
FROM chain_a""")
ORACLE["top5_answers"] = with_(DOCS, chain_ctes(qpairs=None), select="""
SELECT source, topic_id, CAST(seg AS BIGINT) AS seg, author_id, answer, CAST(answer_k AS BIGINT) AS answer_k
FROM chain_a WHERE answer_k < 5""")
ORACLE["emit_order"] = with_(CONV, QP, chain_ctes(), quote_dialog_cte(), PAIRS, select=f"""
SELECT {DK}, CAST(row_number() OVER (ORDER BY {DK}) - 1 AS BIGINT) AS line_no FROM pairs""")

# --------------------------------------------------------------------------
# cleaning, text scalars
# --------------------------------------------------------------------------
ORACLE["scan_posts"] = with_(CONV, select="""
SELECT source, topic_id, url, author_id, author_name, text, pos FROM posts WHERE coalesce(topic_id <> 'topic_id', true)""")
ORACLE["dedup_posts"] = with_(DOCS, select="""
SELECT source, topic_id, pos, author_id FROM (
  SELECT *, row_number() OVER (PARTITION BY source, topic_id, text ORDER BY pos) AS rn FROM posts) WHERE rn = 1""")
ORACLE["normalize_ws"] = f"SELECT conv_id, turn, {c1('text')} AS mapped FROM conversations"
ORACLE["strip_ws"] = f"SELECT doc_id, {strip('text')} AS stripped FROM documents"
ORACLE["token_count"] = f"SELECT doc_id, CAST({tokens('text')} AS BIGINT) AS n_tokens FROM documents"
ORACLE["length_code"] = f"SELECT doc_id, {lcode('text')} AS len_code FROM documents"
ORACLE["encode_pairs"] = with_(CONV, two_speaker_ctes(), select=encode_select("v1"))

# --------------------------------------------------------------------------
# statistics and contracts
# --------------------------------------------------------------------------
BOTH = "allposts AS (SELECT * FROM posts UNION ALL SELECT * FROM dposts)"
ORACLE["topic_count"] = with_(CONV, doc_posts_cte("dposts"), BOTH, select="""
SELECT source, count(DISTINCT topic_id) AS n_topics FROM allposts GROUP BY source""")
ORACLE["topic_yield"] = with_(CONV, QP, chain_ctes(), quote_dialog_cte(), PAIRS, select="""
SELECT p.source, p.topic_id, p.n_posts, CAST(coalesce(q.n_pairs, 0) AS BIGINT) AS n_pairs
FROM (SELECT source, topic_id, count(*) AS n_posts FROM posts GROUP BY ALL) p
LEFT JOIN (SELECT source, topic_id, count(*) AS n_pairs FROM pairs GROUP BY ALL) q USING (source, topic_id)""")
ORACLE["topic_progress"] = with_(CONV, doc_posts_cte("dposts"), BOTH, select="""
SELECT source, topic_id, topic_index, n_topics, topic_index / n_topics AS progress FROM (
  SELECT source, topic_id, CAST(row_number() OVER (PARTITION BY source ORDER BY topic_id) - 1 AS BIGINT) AS topic_index,
         count(*) OVER (PARTITION BY source) AS n_topics
  FROM (SELECT DISTINCT source, topic_id FROM allposts))""")
ORACLE["running_size"] = with_(CONV, QP, chain_ctes(), quote_dialog_cte(), PAIRS, select="""
SELECT source, n_lines, CAST(sum(n_lines) OVER (ORDER BY source) AS BIGINT) AS running_lines
FROM (SELECT source, count(*) AS n_lines FROM pairs GROUP BY source)""")
_pcols = ["source", "topic_id", "url", "author_id", "author_name", "text", "pos"]
ORACLE["profile"] = with_(CONV, select="SELECT count(*) AS n_rows, " + ", ".join(
    f"count({c}) AS nonnull_{c}" for c in _pcols) + " FROM posts")
LOSS = "losses AS (SELECT event_id + 1 AS step, value / 100.0 AS loss FROM events)"
ORACLE["perplexity"] = with_(LOSS, select="SELECT round(exp(avg(loss)), 6) AS perplexity, count(*) AS n_batches FROM losses")
ORACLE["loss_windows"] = with_(LOSS, select="""
SELECT * FROM (SELECT CAST(floor((step - 1) / 500) AS BIGINT) AS window, round(avg(loss), 6) AS mean_loss,
                      count(*) AS n_steps FROM losses GROUP BY 1) WHERE n_steps = 500""")
ORACLE["loss_windows_all"] = with_(LOSS, select="""
SELECT CAST(floor((step - 1) / 500) AS BIGINT) AS window, round(avg(loss), 6) AS mean_loss, count(*) AS n_steps FROM losses GROUP BY 1""")
ORACLE["harvest_rate"] = """
SELECT source, n_items, n_pages, seconds, round(CASE WHEN seconds > 0 THEN n_items / seconds END, 6) AS items_per_sec,
       round(CASE WHEN seconds > 0 THEN n_pages * 60 / seconds END, 6) AS pages_per_min FROM (
  SELECT event_type AS source, count(*) AS n_items, count(DISTINCT user_id) AS n_pages, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS seconds
  FROM events GROUP BY event_type)"""
_req = ["author_id", "author_name", "text", "topic_id", "url", "html"]
ORACLE["contract_fields"] = with_(CONV, select="SELECT source, count(*) AS n_posts, " + ", ".join(
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS missing_{c}" for c in _req) + " FROM posts GROUP BY source")
ORACLE["contract_rows"] = with_(CONV, select="""
SELECT p.source, p.url, p.n_rows, CAST(e.expected AS BIGINT) AS expected, coalesce(p.n_rows >= e.expected, true) AS ok
FROM (SELECT source, url, count(*) AS n_rows FROM posts GROUP BY ALL) p
LEFT JOIN (VALUES ('psy_su', 20), ('b17_ru', 50), ('psycheforum_ru', 30), ('psyhelp24_org', 1)) e(source, expected)
USING (source)""")

# --------------------------------------------------------------------------
# sampling, splitting, packing
# --------------------------------------------------------------------------
_h = f"md5(concat_ws(':', '1234', source, topic_id, CAST(emit_pos AS VARCHAR), CAST(emit_k AS VARCHAR), kind))"
RANKED = f"""ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY {_h}, {DK}) - 1 AS BIGINT) AS shuffle_rank, count(*) OVER () AS n_total
  FROM lines)"""
LINE_CTES = (CONV, QP, chain_ctes(), quote_dialog_cte(), PAIRS, LINES, RANKED)
ORACLE["shuffle"] = with_(*LINE_CTES, select=f"SELECT {DK}, line, shuffle_rank FROM ranked")
ORACLE["cap_sample"] = with_(*LINE_CTES, select=f"SELECT {DK}, line, shuffle_rank FROM ranked WHERE shuffle_rank < 300000")
ORACLE["cap_sample_100"] = with_(*LINE_CTES, select=f"SELECT {DK}, line, shuffle_rank FROM ranked WHERE shuffle_rank < 100")
SPLIT = f"""splitted AS (
  SELECT {DK}, line, shuffle_rank,
         CASE WHEN shuffle_rank < CAST(floor(n_total * 0.8 + 0.5) AS BIGINT) THEN 'train' ELSE 'test' END AS split
  FROM ranked)"""
ORACLE["split_all"] = with_(*LINE_CTES, SPLIT, select="SELECT * FROM splitted")
ORACLE["split_train"] = with_(*LINE_CTES, SPLIT, select="SELECT * FROM splitted WHERE split = 'train'")
ORACLE["split_test"] = with_(*LINE_CTES, SPLIT, select="SELECT * FROM splitted WHERE split = 'test'")
ORACLE["split_sizes"] = with_(*LINE_CTES, SPLIT, select="SELECT split, count(*) AS n_rows FROM splitted GROUP BY split")


def pack_sql(src: str, order: str, text: str, size: int, keep_last: bool = False) -> str:
    having = "" if keep_last else f"HAVING count(*) = {size}"
    return f"""
pk_l AS (
  SELECT {order}, list_append(regexp_extract_all({c1(text)}, {sql_str(PRETOKEN_RE2)}), chr(10)) AS toks FROM {src}
),
pk_o AS (
  SELECT *, coalesce(sum(len(toks)) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM pk_l
),
pk_t AS (SELECT start + u.i - 1 AS off, u.tok FROM pk_o, unnest(toks) WITH ORDINALITY AS u(tok, i)),
blocks AS (
  SELECT CAST(floor(off / {size}) AS BIGINT) AS block_id, CAST(count(*) AS BIGINT) AS n_tokens,
         string_agg(tok, '' ORDER BY off) AS block_text
  FROM pk_t GROUP BY 1 {having}
)"""


ORACLE["pack_blocks"] = with_(*LINE_CTES[:-1], pack_sql("lines", DK, "line", 2048), select="SELECT * FROM blocks")
ORACLE["pack_blocks_keep_last"] = with_(*LINE_CTES[:-1], pack_sql("lines", DK, "line", 2048, True), select="SELECT * FROM blocks")
ORACLE["pack_blocks_docs"] = with_(pack_sql("documents", "doc_id", "text", 1024), select="SELECT * FROM blocks")
ORACLE["pad_batches"] = with_(f"""blocks AS (
  SELECT CAST(doc_id AS BIGINT) AS block_id, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, '') AS block_text FROM (
    SELECT doc_id, list_append(regexp_extract_all({c1("coalesce(text, '')")}, {sql_str(PRETOKEN_RE2)}), chr(10)) AS toks FROM documents))""", select="""
SELECT block_id, batch_id, n_tokens, padded_len, CAST(padded_len - n_tokens AS BIGINT) AS n_pad,
       block_text || repeat('<pad>', padded_len - n_tokens) AS padded_text FROM (
  SELECT *, max(n_tokens) OVER (PARTITION BY batch_id) AS padded_len FROM (
    SELECT *, CAST(floor(block_id / 4) AS BIGINT) AS batch_id FROM blocks))""")

# --------------------------------------------------------------------------
# prompts and replies
# --------------------------------------------------------------------------
TURNS = """turns AS (
  SELECT conv_id, turn, CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 1 END AS speaker, text
  FROM conversations WHERE role IN ('user', 'assistant'))"""


def prompt_sql(frame: str) -> str:
    lc = lcode("coalesce(text, '')")
    piece = f"'|' || CAST(speaker AS VARCHAR) || '|' || {lc} || '|' || coalesce(text, '')"
    return with_(TURNS, select=f"""
SELECT conv_id, turn, prompt FROM (
  SELECT conv_id, turn, speaker,
         string_agg(piece, '' ORDER BY turn) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN {frame} AND CURRENT ROW)
           || '|1|-|' AS prompt
  FROM (SELECT *, {piece} AS piece FROM turns)) WHERE speaker = 0""")


ORACLE["prompt_last5"] = prompt_sql("4 PRECEDING")
ORACLE["prompt_full"] = prompt_sql("UNBOUNDED PRECEDING")
ORACLE["parse_reply"] = with_(*LINE_CTES[:-1], select=f"SELECT {DK}, string_split(line, '|')[-1] AS reply FROM lines")
ORACLE["pick_reply"] = with_(DOCS, chain_ctes(qpairs=None), select="""
SELECT source, topic_id, emit_pos, o[1] AS reply, CAST(len(o) - 1 AS BIGINT) AS n_alternatives FROM (
  SELECT source, topic_id, emit_pos, list(speaker1_text ORDER BY emit_k) AS o FROM chain GROUP BY ALL)""")


# --------------------------------------------------------------------------
# pages
# --------------------------------------------------------------------------
from threadloom.operators.html_tokens import PAGE_CONTAINERS  # noqa: E402
from threadloom.operators.links import HAS_HREF, LINK_RULES, TOPIC_ID_IN_URL  # noqa: E402

PTOK = token_ctes("pages", ["page_id"], [], name="ptok", ancestors=1, count_tags=PAGE_CONTAINERS)
PTOK0 = token_ctes("pages", ["page_id"], [], name="ptok", ancestors=0, count_tags=PAGE_CONTAINERS)
LTOK0 = token_ctes("lpages", ["page_id"], [], name="ptok", ancestors=0, count_tags=PAGE_CONTAINERS)
PK = "page_id"

ORACLE["scan_pages"] = r"""
SELECT page_id, url, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)', 1)) AS host,
       CAST(length(html) AS BIGINT) AS n_chars FROM pages"""
ORACLE["html_tokens"] = with_(PTOK, select="""
SELECT page_id, tpos // 1048576 AS tpos, kind, tag, CAST(d_before AS BIGINT) AS depth,
       CASE WHEN is_elem OR (kind = 'close' AND delta = -1) THEN anc1.tag ELSE anc0.tag END AS parent_tag, text
FROM ptok""")
ORACLE["html_depth"] = with_(PTOK0, select="""
SELECT page_id, count(*) AS n_tokens, CAST(count_if(is_elem) AS BIGINT) AS n_elements, CAST(max(d_after) AS BIGINT) AS max_depth,
       CAST(arg_max(d_after, tpos) AS BIGINT) AS end_depth
FROM ptok GROUP BY page_id""")


def _agg_text(cond: str, value: str, sep: str) -> str:
    return f"coalesce(string_agg({value}, {sep} ORDER BY tpos) FILTER (WHERE {cond}), '')"


ORACLE["element_text"] = with_(PTOK0, select=f"""
SELECT page_id, {_agg_text("kind = 'text' AND in_a > 0", 'text', 'chr(10)')} AS article_text FROM (
  SELECT *, {_inside(_pred('anc0', 'article'), PK)} AS in_a FROM ptok) GROUP BY page_id""")
ORACLE["direct_text"] = with_(PTOK0, select=f"""
SELECT page_id, {_agg_text("kind = 'text' AND " + _pred('anc0', 'h1'), 'text', "''")} AS h1_text
FROM ptok GROUP BY page_id""")
ORACLE["element_attr"] = with_(PTOK0, select=f"""
SELECT page_id, min({{'tpos': tpos, 'v': {_attr('lang')}}}) FILTER (WHERE kind = 'open' AND tag = 'html').v AS lang
FROM ptok GROUP BY page_id""")
_own_article = f"((is_elem OR (kind = 'close' AND delta = -1)) AND {_pred('anc0', 'article')})"
ORACLE["element_html"] = with_(PTOK0, select=f"""
SELECT page_id, {_agg_text('in_a > 0 OR ' + _own_article, 'tok', "''")} AS article_html FROM (
  SELECT *, {_inside(_pred('anc0', 'article'), PK)} AS in_a FROM ptok) GROUP BY page_id""")
ORACLE["field_join"] = with_(PTOK0, select=f"""
SELECT page_id, CAST(len(m) AS BIGINT) AS n_values, array_to_string(m, '-') AS joined,
       list_filter(v, lambda x: x IS NOT NULL AND x <> '')[1] AS first_value FROM (
  SELECT page_id, v, list_filter(list_transform(v, lambda x: nullif({strip('x')}, '')), lambda x: x IS NOT NULL) AS m
  FROM (SELECT page_id, coalesce(list(text ORDER BY tpos) FILTER (WHERE kind = 'text' AND in_nav > 0), []) AS v
        FROM (SELECT *, {_inside(_pred('anc0', 'nav'), PK)} AS in_nav FROM ptok) GROUP BY page_id))""")
LINKS_CTE = f"""plinks AS (
  SELECT page_id, url, CAST(u.i - 1 AS BIGINT) AS link_no, {_decode('u.h', True)} AS href
  FROM lpages, unnest(list_transform(list_filter(regexp_extract_all(regexp_replace(html, {sql_str(DROP_RE)}, '', 'g'),
                                                                   {sql_str(A_TAG_PATTERN)}),
                                                 lambda t: regexp_matches(t, {sql_str(HAS_HREF)})),
                                     lambda t: {_attr('href', 't')}))
       WITH ORDINALITY AS u(h, i))"""


def _no_dots_sql(path: str) -> str:
    segs = f"string_split({path}, '/')[2:]"
    kept = (f"list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform({segs}, lambda s: [s])), lambda acc, x: CASE WHEN x[1] = '.' THEN acc "
            f"WHEN x[1] = '..' THEN acc[1:len(acc) - 1] ELSE list_concat(acc, x) END)")
    end = f"CASE WHEN {segs}[-1] IN ('.', '..') THEN list_append({kept}, '') ELSE {kept} END"
    return f"CASE WHEN strpos({path}, '/.') > 0 THEN '/' || array_to_string({end}, '/') ELSE {path} END"


def url_join_sql(base: str, href: str) -> str:
    sch = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*):', 1)"
    origin = f"regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1)"
    folder = f"coalesce(nullif(regexp_extract({base}, '^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*(/[^?#]*/|/)', 1), ''), '/')"
    path, rest = f"regexp_extract({href}, '^([^?#]*)', 1)", f"regexp_extract({href}, '^[^?#]*(.*)$', 1, 's')"
    no_frag = f"regexp_extract({base}, '^([^#]*)', 1)"
    no_query = f"regexp_extract({base}, '^([^?#]*)', 1)"
    return f"""(CASE WHEN regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {href}
      WHEN starts_with({href}, '//') THEN {sch} || ':' || {href}
      WHEN starts_with({href}, '/') THEN {origin} || {_no_dots_sql(path)} || {rest}
      WHEN starts_with({href}, '?') THEN {no_query} || {href}
      WHEN starts_with({href}, '#') THEN {no_frag} || {href}
      WHEN {href} = '' THEN {no_frag}
      ELSE {origin} || {_no_dots_sql('(' + folder + ' || ' + path + ')')} || {rest} END)"""


def link_rule_sql(u: str) -> str:
    out = "NULL"
    host = f"lower(regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#:@]*)', 1))"
    for name, domain, allow, deny, ids in reversed(LINK_RULES):
        ok = (f"({host} = '{domain}' OR ends_with({host}, '.{domain}')) "
              f"AND regexp_matches({u}, {sql_str(allow)})")
        if deny:
            ok += f" AND NOT regexp_matches({u}, {sql_str(deny)})"
        if ids:
            idl = ", ".join(sql_str(i) for i in ids)
            ok += f" AND NOT coalesce(regexp_extract({u}, {sql_str(TOPIC_ID_IN_URL)}, 1) IN ({idl}), false)"
        out = f"CASE WHEN {ok} THEN '{name}' ELSE {out} END"
    return out


RESOLVED = f"rlinks AS (SELECT *, {url_join_sql('url', 'href')} AS abs_url FROM plinks)"
REGION = with_  # alias for readability below
NAV_LINKS = f"""navlinks AS (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY tpos) - 1 AS BIGINT) AS link_no,
         {_decode(_attr('href'), True)} AS href
  FROM (SELECT *, {_inside(_pred('anc0', 'nav'), PK)} AS in_nav FROM ptok)
  WHERE kind = 'open' AND tag = 'a' AND in_nav > 0)"""
PAGER = """pager AS (
  SELECT p.page_id, p.url, n.pager FROM lpages p
  LEFT JOIN (SELECT page_id, list(href ORDER BY link_no) AS pager FROM navlinks GROUP BY page_id) n USING (page_id))"""

# --------------------------------------------------------------------------
# forum pages rendered from conversations, and extraction back to posts
# --------------------------------------------------------------------------
def forum_pages_cte(name: str = "fpages", per_page: int = 3) -> str:
    a, b, c, d = SITE_SOURCES
    tid = "CAST(conv_id AS VARCHAR)"
    t = esc("coalesce(text, '')")
    cells = (f"'<td><p class=\"fio\"><a href=\"/' || role || '/\">' || role || '</a></p></td><td>' || {t} || '</td>'")
    prof = "(CASE WHEN role = 'user' THEN '11' WHEN role = 'assistant' THEN '22' END)"
    link = (f"(CASE WHEN {prof} IS NOT NULL THEN '<a href=\"https://psycheforum.ru/profile/' || {prof} || '-' || role "
            f"|| '/\">' || role || '</a>' ELSE '<a href=\"#\">' || role || '_' || {tid} || '</a>' END)")
    row = f"""CASE WHEN source = '{a}' THEN '<tr><td class="author"><span>#</span><img src="/i.png"><a href="/club/profile/' || role || '/">' || role || '</a></td><td><div class="text">' || {t} || '</div></td></tr>'
      WHEN source = '{b}' THEN '<div><table><tr>' || {cells} || '</tr></table></div>'
      WHEN source = '{c}' THEN '<article><aside><h3><strong>' || {link} || '</strong></h3></aside><div data-role="commentContent"><p>' || {t} || '</p></div></article>'
      ELSE (CASE WHEN role = 'assistant' THEN '<blockquote><p><strong>' || role || '</strong>: ' || {t} || '</p></blockquote>'
                 WHEN role = 'user' THEN '<p><strong>' || role || '</strong>: ' || {t} || '</p>'
                 ELSE '<p>' || {t} || '</p>' END) END"""
    title = esc(f"'Topic ' || {tid}")
    word = "CASE WHEN substr(md5(topic_id), 2, 1) = '0' THEN 'tema' ELSE 'topic' END"
    h1 = f"CASE WHEN substr(md5(topic_id), 2, 1) = '1' THEN ' ' ELSE {title} END"
    nxt = "CAST(page_no + 1 AS VARCHAR)"
    pager = f"""CASE WHEN page_no > 2 THEN ''
      WHEN source = '{b}' THEN '<div class="body_padding"><div class="page-list"><span><a rel="prev" href="?id=0">0</a><a rel="nofollow" href="topic.php?id=' || topic_id || '&amp;page=' || {nxt} || '">next</a></span></div></div>'
      WHEN source = '{c}' THEN '<ul><li class="ipsPagination_prev"><a href="#">p</a></li><li class="ipsPagination_next wide"><a href="https://psycheforum.ru/topic/' || topic_id || '-t/page/' || {nxt} || '/">next</a></li></ul>'
      ELSE '' END"""
    odd = ("""'<p>&euro;5 &eacutet &amp;lt;b&amp;gt; &#38;lt;i&#x26;gt; &notit; &notin; &#150;</p><a href="?a=1&amp;copy=2&copy=3&lt">n</a>' || """
           "CASE WHEN substr(md5(topic_id), 5, 1) IN ('0', '1') THEN '<img alt=' || repeat('x', 20000) || '><a href=/' || repeat('y', 9000) || '>o</a>' ELSE '' END")
    unclosed = "CASE WHEN substr(md5(topic_id), 5, 1) IN ('1', '2') THEN '<a title=' || repeat('z ', 10000) ELSE '' END"
    tail = f"""('<nav class="crumbs wide"><a href="../">up</a><a href="?page=' || {nxt} || '">more</a></nav>' || {pager} ||
      '<footer><a href="//psycheforum.ru/forum/17-x/">a</a><a href="https://psycheforum.ru/forum/17-x/?do=markRead">b</a><a href="https://www.b17.ru/forum/topic.php?id=' || topic_id ||
      '">c</a><a href="https://www.b17.ru/forum/topic.php?id=' || topic_id || '&amp;p=2">d</a><a href="https://psycheforum.ru/topic/' || topic_id ||
      '-t/">e</a><a href="https://psycheforum.ru/topic/3273-t/">f</a><a href="https://psyhelp24.org/psihologicheskaya-konsultatsiya-' || topic_id ||
      '/">g</a><a href="#top">h</a><a href="">i</a><a href="./x/../y/./z.html?q=../r#s">j</a><a href="../../../w">k</a><a href="/p/./q/..">l</a><a href="' ||
      {esc('url')} || '#seen">m</a>' || {odd} || '</footer></body></html>' || {unclosed})"""
    head = f"'<html><head><title>' || {title} || '</title></head><body>'"
    return f"""
{name}_c AS (
  SELECT *, CAST(floor(turn / CASE WHEN source = '{d}' THEN 64 ELSE {per_page} END) AS INTEGER) + 1 AS page_no,
         {row} AS row_html
  FROM (SELECT conv_id, turn, role, text, {tid} AS topic_id,
               CASE WHEN {hexd(tid)} IN ('0','1','2','3') THEN '{a}' WHEN {hexd(tid)} IN ('4','5','6','7') THEN '{b}'
                    WHEN {hexd(tid)} IN ('8','9','a','b') THEN '{c}' ELSE '{d}' END AS source
        FROM (SELECT conv_id, turn, role, CASE WHEN {hexd(tid)} IN ('0','1','2','3') AND substr(md5({tid} || ':' || CAST(turn AS VARCHAR)), 3, 1) = '0'
                                               THEN ' ' ELSE text END AS text FROM conversations))
),
{name}_r AS (
  SELECT source, topic_id, conv_id, page_no,
         coalesce(string_agg(row_html, '' ORDER BY turn) FILTER (WHERE NOT (source = '{b}' AND turn = 0)), '') AS body
  FROM {name}_c GROUP BY source, topic_id, conv_id, page_no
),
{name}_o AS (SELECT {tid} AS topic_id, '<tr>' || {cells} || '</tr>' AS opening FROM conversations WHERE turn = 0),
{name}_u AS (
  SELECT *,
    CASE WHEN source = '{a}' THEN 'https://psy.su/club/forum/' || {word} || '/' || topic_id || '/' || CASE WHEN page_no > 1 THEN '?page=' || CAST(page_no AS VARCHAR) ELSE '' END
         WHEN source = '{b}' THEN 'https://www.b17.ru/forum/' || {word} || '.php?id=' || topic_id || CASE WHEN page_no > 1 THEN '&page=' || CAST(page_no AS VARCHAR) ELSE '' END
         WHEN source = '{c}' THEN 'https://psycheforum.ru/' || {word} || '/' || topic_id || '-t/' || CASE WHEN page_no > 1 THEN 'page/' || CAST(page_no AS VARCHAR) || '/' ELSE '' END
         ELSE 'https://psyhelp24.org/psihologicheskaya-konsultatsiya-' || topic_id || '/' END AS url
  FROM {name}_r LEFT JOIN {name}_o USING (topic_id)
),
{name} AS (
  SELECT source, topic_id, page_no, url,
    CASE WHEN source = '{a}' THEN {head} || '<h1>' || {title} || '</h1><table class="forum"><tr><th>Author</th><th>Text</th></tr>' || body || '</table>' || {tail}
         WHEN source = '{b}' THEN {head} || '<h1> ' || {h1} || ' </h1><div class="body_padding"><div id="table-forum-post"><div><table>' || coalesce(opening, '') || '</table></div></div><div id="topic_post_list">' || body || '</div></div>' || {tail}
         WHEN source = '{c}' THEN {head} || '<h1>' || {h1} || '</h1>' || body || {tail}
         ELSE {head} || '<h2>' || {title} || '</h2><div class="post-content"><p>' || {title} || '</p><p>Psychologist</p><p><img src="/p.jpg"></p>' || body || '</div>' || {tail} END AS html
  FROM {name}_u
)"""


FK = ["source", "topic_id", "page_no"]
FKS = ", ".join(FK)
_W = f"(PARTITION BY {FKS} ORDER BY tpos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def _region_stages(src: str, name: str, flag: str) -> tuple[str, str]:
    """Two CTEs computing region column ``name`` for elements where ``flag``."""
    s1 = f"""{src}_{name}1 AS (
  SELECT *, ({flag}) AS {name}_flag, last_value(CASE WHEN {flag} THEN tpos END IGNORE NULLS) OVER {_W} AS {name}_opened
  FROM {src})"""
    own = f"(kind = 'close' AND delta = -1 AND anc0.tpos = {name}_opened)"
    s2 = f"""{src}_{name} AS (
  SELECT * EXCLUDE ({name}_flag, {name}_opened, {name}_cur),
         CASE WHEN {own} THEN anc0.tpos ELSE {name}_cur END AS {name} FROM (
    SELECT *, coalesce(last_value(CASE WHEN {name}_flag THEN tpos WHEN {own} THEN -1 END IGNORE NULLS) OVER {_W}, -1)
              AS {name}_cur
    FROM {src}_{name}1))"""
    return s1, s2


def _href(x: str) -> str:
    return _attr("href", x)


def extraction_ctes(pages: str = "fpages") -> list[str]:
    a, b, c, d = SITE_SOURCES
    ctes = [token_ctes(pages, FK, [], name="ft", ancestors=3)]
    ctes.append(f"""ft_s AS (
  SELECT *, CASE WHEN kind = 'open' THEN (CASE WHEN is_elem THEN anc1.tpos ELSE anc0.tpos END) END AS parent_tpos FROM ft)""")
    ctes.append(f"""ft_i AS (
  SELECT *,
    CASE WHEN kind = 'open' THEN row_number() OVER (PARTITION BY {FKS}, kind = 'open', parent_tpos ORDER BY tpos) END AS child_index,
    CASE WHEN kind = 'open' THEN row_number() OVER (PARTITION BY {FKS}, kind = 'open', parent_tpos, tag ORDER BY tpos) END AS tag_index
  FROM ft_s)""")
    ctes.append(f"""ft_f AS (
  SELECT *, {_inside(_pred('anc0', 'table', 'forum'), FKS)} AS in_forum,
            {_inside(_pred('anc0', 'p', 'fio'), FKS)} AS in_fio,
            {_inside(_pred('anc0', 'td', 'author'), FKS)} AS in_author
  FROM ft_i)""")
    rec = f"""coalesce(CASE WHEN source = '{a}' THEN is_elem AND tag = 'tr' AND in_forum > 0
      WHEN source = '{b}' THEN is_elem AND tag = 'tr' AND tag_index = 1 AND {_pred('anc1', 'table')} AND {_pred('anc2', 'div')}
           AND ({_pred('anc3', 'div', eid='topic_post_list')} OR (page_no = 1 AND {_pred('anc3', 'div', eid='table-forum-post')}))
      WHEN source = '{c}' THEN is_elem AND tag = 'article'
      ELSE is_elem AND tag IN ('p', 'blockquote') AND {_pred('anc1', 'div', 'post-content')} END, false)"""
    ctes.append(f"ft_r AS (SELECT *, {rec} AS rec_open FROM ft_f)")
    prev = "ft_r"
    for nm, flag in (("rec", "rec_open"), ("dt", f"is_elem AND {_pred('anc0', 'div', 'text')}"),
                     ("cc", f"is_elem AND {_pred('anc0', 'div', role='commentContent')}")):
        s1, s2 = _region_stages(prev, nm, flag)
        ctes += [s1, s2]
        prev = f"{prev}_{nm}"
    s1, s2 = _region_stages(prev, "td", "is_elem AND tag = 'td' AND anc1.tpos = rec")
    ctes += [s1, s2]
    prev = f"{prev}_td"
    ctes.append(f"ftok AS (SELECT * FROM {prev})")
    ctes.append(f"""recs AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {FKS} ORDER BY rec) - 1 AS BIGINT) AS rec_no FROM (
    SELECT {FKS}, rec, list({{'tpos': tpos, 'kind': kind, 'tok': tok, 'text': text, 'tag': tag, 'p0': anc0.tpos,
                             't0': anc0.tag, 'p1': anc1.tpos, 't1': anc1.tag, 't2': anc2.tag, 'child_index': child_index,
                             'dt': dt, 'cc': cc, 'td': td, 'in_fio': in_fio, 'in_author': in_author,
                             'rec_open': rec_open}} ORDER BY tpos) AS toks
    FROM ftok WHERE rec >= 0 GROUP BY {FKS}, rec))""")
    txt = "lambda x: x.text"
    ctes.append(f"""recs_a AS (
  SELECT *,
    list_filter(toks, lambda x: x.kind = 'open' AND x.tag = 'a' AND x.child_index = 3 AND x.t1 = 'td' AND x.in_author > 0)[1] AS a_link,
    list_transform(list_filter(toks, lambda x: x.kind = 'text' AND x.dt >= 0), {txt}) AS a_parts,
    list_min(list_transform(list_filter(toks, lambda x: x.dt >= 0), lambda x: x.dt)) AS a_first_dt,
    list_sort(list_distinct(list_transform(list_filter(toks, lambda x: x.td >= 0), lambda x: x.td))) AS b_tds,
    list_filter(toks, lambda x: x.kind = 'open' AND x.tag = 'a' AND x.t1 = 'strong' AND x.t2 = 'h3')[1] AS c_link,
    list_filter(toks, lambda x: x.rec_open)[1].tag = 'blockquote' AS d_quote
  FROM recs)""")
    ctes.append(f"""fields AS (
  SELECT {FKS}, rec, rec_no,
    CASE WHEN source = '{a}' THEN CASE WHEN a_link IS NOT NULL THEN {_href('a_link.tok')} END
         WHEN source = '{b}' THEN list_transform(list_filter(toks, lambda x: x.kind = 'open' AND x.td = b_tds[1] AND x.in_fio > 0
                                   AND {_href('x.tok')} <> ''), lambda x: {_href('x.tok')})[1]
         WHEN source = '{c}' THEN CASE WHEN c_link IS NOT NULL THEN {_href('c_link.tok')} END END AS author_href,
    CASE WHEN source = '{a}' THEN list_transform(list_filter(toks, lambda x: x.kind = 'text' AND x.p0 = a_link.tpos), {txt})[1]
         WHEN source = '{b}' THEN {strip(f"list_transform(list_filter(toks, lambda x: x.kind = 'text' AND x.td = b_tds[1] AND x.in_fio > 0), {txt})[1]")}
         WHEN source = '{c}' THEN list_transform(list_filter(toks, lambda x: x.kind = 'text' AND x.p0 = c_link.tpos), {txt})[1]
         ELSE list_transform(list_filter(toks, lambda x: x.kind = 'text' AND x.t0 = 'strong'), {txt})[1] END AS author_name,
    CASE WHEN source = '{a}' THEN {strip("array_to_string(a_parts, chr(10))")}
         WHEN source = '{b}' THEN array_to_string(list_transform(list_filter(toks, lambda x: x.kind = 'text' AND x.td = b_tds[2]), lambda x: {strip('x.text')}), chr(10))
         WHEN source = '{c}' THEN array_to_string(list_transform(list_filter(toks, lambda x: x.kind = 'text' AND x.cc >= 0), lambda x: {strip('x.text')}), chr(10))
         ELSE array_to_string(list_transform(list_filter(toks, lambda x: x.kind = 'text' AND CASE WHEN d_quote THEN x.t0 = 'p' AND x.p1 = rec ELSE x.p0 = rec END), {txt}), chr(10)) END AS text,
    CASE WHEN source = '{a}' THEN array_to_string(list_transform(list_filter(toks, lambda x: x.dt = a_first_dt), lambda x: x.tok), '')
         WHEN source = '{b}' THEN {strip("array_to_string(list_transform(list_filter(toks, lambda x: x.td = b_tds[2]), lambda x: x.tok), '')")}
         WHEN source = '{c}' THEN {strip("array_to_string(list_transform(list_filter(toks, lambda x: x.cc >= 0), lambda x: x.tok), '')")}
         ELSE array_to_string(list_transform(toks, lambda x: x.tok), '') END AS html,
    CASE WHEN source = '{a}' THEN len(a_parts) > 0 ELSE true END AS has_text,
    CASE WHEN source = '{d}' THEN CASE WHEN d_quote THEN '1' ELSE '0' END END AS role
  FROM recs_a)""")
    ctes.append(f"""fx1 AS (
  SELECT * FROM (
    SELECT *, CASE WHEN coalesce(max(CASE WHEN rec_no = 3 THEN role = '1' END) OVER (PARTITION BY {FKS}), false) THEN 4 ELSE 3 END AS d_start
    FROM fields WHERE NOT (source = '{a}' AND rec_no = 0))
  WHERE source <> '{d}' OR rec_no >= d_start)""")
    ctes.append(f"""fx2 AS (
  SELECT * EXCLUDE (author_name),
    CASE WHEN source = '{d}' THEN first_value(author_name IGNORE NULLS) OVER (PARTITION BY {FKS}, role ORDER BY rec_no
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE author_name END AS author_name
  FROM fx1)""")
    ctes.append(f"""extracted AS (
  SELECT * EXCLUDE (text),
    CASE WHEN source = '{d}' THEN (CASE WHEN starts_with(text, ':') THEN {strip('substring(text, 2)')} ELSE {strip('text')} END)
         ELSE text END AS text,
    (source <> '{a}' OR (has_text AND text <> '')) AS ready
  FROM fx2 WHERE source <> '{d}' OR coalesce(length(text) >= 2, false))""")
    return ctes


def topic_id_sql(src: str, url: str) -> str:
    from threadloom.operators.extract import TOPIC_ID_PATTERNS
    d = SITE_SOURCES[3]
    parts = []
    for site, pat in TOPIC_ID_PATTERNS:
        v = f"regexp_extract({url}, {sql_str(pat)}, 1)"
        v = f"(CASE WHEN {v} <> '' THEN {v} ELSE '0' END)" if site == d else f"nullif({v}, '')"
        parts.append(f"WHEN {src} = '{site}' THEN {v}")
    return "(CASE " + " ".join(parts) + " END)"


def author_id_sql(src: str, href: str) -> str:
    from threadloom.operators.extract import AUTHOR_ID_PATTERNS
    b = SITE_SOURCES[1]
    parts = []
    for site, pat in AUTHOR_ID_PATTERNS:
        h = strip(href) if site == b else href
        parts.append(f"WHEN {src} = '{site}' THEN nullif(regexp_extract({h}, {sql_str(pat)}, 1), '')")
    return "(CASE " + " ".join(parts) + " END)"


FP = forum_pages_cte()
LPAGES = """lpages AS (
  SELECT page_id, url, html FROM pages
  UNION ALL SELECT -(CAST(topic_id AS BIGINT) * 1000 + page_no + 1), url, html FROM fpages)"""
ORACLE["topic_title"] = with_(FP, LPAGES, LTOK0, select=f"""
SELECT page_id, h1d[1] AS title_a,
       array_to_string(list_filter(list_transform(h1, lambda x: nullif({strip('x')}, '')), lambda x: x IS NOT NULL), '-') AS title_b,
       {strip("array_to_string(h1, ' ')")} AS title_c, h2[1] AS title_d FROM (
  SELECT page_id,
         coalesce(list(text ORDER BY tpos) FILTER (WHERE kind = 'text' AND {_pred('anc0', 'h1')}), []) AS h1d,
         coalesce(list(text ORDER BY tpos) FILTER (WHERE kind = 'text' AND in_h1 > 0), []) AS h1,
         coalesce(list(text ORDER BY tpos) FILTER (WHERE kind = 'text' AND in_h2 > 0), []) AS h2
  FROM (SELECT *, {_inside(_pred('anc0', 'h1'), PK)} AS in_h1, {_inside(_pred('anc0', 'h2'), PK)} AS in_h2 FROM ptok)
  GROUP BY page_id)""")

ORACLE["links"] = with_(FP, LPAGES, LINKS_CTE, select="SELECT page_id, url, link_no, href FROM plinks")
ORACLE["links_in_region"] = with_(FP, LPAGES, LTOK0, NAV_LINKS, select="SELECT * FROM navlinks")
ORACLE["url_join"] = with_(FP, LPAGES, LINKS_CTE, RESOLVED, select="SELECT page_id, link_no, abs_url FROM rlinks")
ORACLE["link_rules"] = with_(FP, LPAGES, LINKS_CTE, RESOLVED, select=f"""
SELECT *, {link_rule_sql('abs_url')} AS rule FROM (
  SELECT page_id, link_no, abs_url FROM rlinks UNION ALL SELECT page_id, CAST(-1 AS BIGINT), url FROM lpages)""")
_path = r"regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/$', '')"
ORACLE["next_page"] = with_(FP, LPAGES, LTOK0, NAV_LINKS, PAGER, select=f"""
SELECT page_id, CASE WHEN len(coalesce(pager, [])) = 0 THEN NULL
                     WHEN list_position(pager, {_path}) IS NULL THEN pager[1]
                     ELSE pager[list_position(pager, {_path}) + 1] END AS next_href
FROM pager""")
ORACLE["next_topic_page"] = with_(FP, LPAGES, LTOK0, NAV_LINKS, PAGER, select=r"""
SELECT page_id, CASE WHEN len(coalesce(pager, [])) = 0 THEN NULL
                     WHEN strpos(url, '?page=') = 0 THEN pager[1]
                     WHEN regexp_extract(url, '\?page=(\d+)', 1) <> ''
                          AND CAST(regexp_extract(url, '\?page=(\d+)', 1) AS INTEGER) >= 1
                       THEN pager[CAST(regexp_extract(url, '\?page=(\d+)', 1) AS INTEGER)] END AS next_href
FROM pager""")
ORACLE["frontier"] = with_(FP, LPAGES, LINKS_CTE, RESOLVED, select=r"""
SELECT DISTINCT url FROM (
  SELECT regexp_replace(abs_url, '#.*$', '') AS url FROM rlinks) c
WHERE lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)', 1)) IN
      (SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)', 1)) FROM lpages)
  AND url NOT IN (SELECT regexp_replace(url, '#.*$', '') FROM lpages WHERE url IS NOT NULL)""")


LTOK3 = token_ctes("lpages", ["page_id"], [], name="ptok", ancestors=3)


def next_first_ctes(pages: str, key: str) -> list[str]:
    into = "is_elem AND coalesce(anc0.tag = 'li' AND strpos(anc0.cls, 'ipsPagination_next') > 0, false)"
    out = "kind = 'close' AND delta = -1 AND coalesce(anc0.tag = 'li' AND strpos(anc0.cls, 'ipsPagination_next') > 0, false)"
    return [f"""nf AS (
  SELECT *, sum(CASE WHEN {into} THEN 1 WHEN {out} THEN -1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY tpos
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - CASE WHEN {into} THEN 1 ELSE 0 END AS in_li FROM ptok)""", f"""nfirst AS (
  SELECT {key},
    min({{'tpos': tpos, 'href': {_decode(_attr('href'), True)}}}) FILTER (WHERE kind = 'open' AND tag = 'a' AND {_attr('rel')} = 'nofollow'
      AND coalesce(anc1.tag = 'span' AND anc2.cls = 'page-list' AND anc3.cls = 'body_padding', false)).href AS b,
    min({{'tpos': tpos, 'href': {_decode(_attr('href'), True)}}}) FILTER (WHERE kind = 'open' AND in_li > 0 AND {_attr('href')} <> '').href AS c
  FROM nf GROUP BY {key})""", f"""nextf AS (
  SELECT p.{key}, CASE WHEN n.b IS NOT NULL THEN {url_join_sql('p.url', 'n.b')} ELSE n.c END AS next_href
  FROM {pages} p LEFT JOIN nfirst n USING ({key}))"""]


ORACLE["next_page_first"] = with_(FP, LPAGES, LTOK3, *next_first_ctes("lpages", "page_id"), select="SELECT page_id, next_href FROM nextf")
ORACLE["contract_follow_ups"] = with_(FP, f"bpages AS (SELECT url, url AS page, html FROM fpages WHERE source = '{SITE_SOURCES[1]}')",
    token_ctes("bpages", ["page"], [], name="ptok", ancestors=3), *next_first_ctes("bpages", "page"), select="""
SELECT page AS url, CAST(next_href IS NOT NULL AS BIGINT) AS n_follow_ups, next_href IS NOT NULL AS ok FROM nextf""")
EX = extraction_ctes()
_POST_OUT = "source, topic_id, page_no, rec_no, author_href, author_name, text, html"
for _k, _s in (("posts_site_a", 0), ("posts_site_b", 1), ("posts_site_c", 2)):
    ORACLE[_k] = with_(FP, *EX, select=f"SELECT {_POST_OUT} FROM extracted WHERE ready AND source = '{SITE_SOURCES[_s]}'")
ORACLE["posts_site_d"] = with_(FP, *EX, select=f"SELECT {_POST_OUT}, role FROM extracted WHERE source = '{SITE_SOURCES[3]}'")
ORACLE["page_yield"] = with_(FP, *EX, select=f"""
SELECT {FKS}, count(*) AS n_rows, CAST(count_if(ready) AS BIGINT) AS n_ready FROM extracted WHERE source = '{SITE_SOURCES[0]}' GROUP BY {FKS}""")
ORACLE["drop_repeat_opening"] = with_(FP, *EX, select=f"""
SELECT {FKS}, tpos // 1048576 AS tpos FROM ftok
WHERE source = '{SITE_SOURCES[1]}' AND page_no > 1 AND is_elem AND tag = 'tr' AND {_pred('anc3', 'div', eid='table-forum-post')}""")
GUESTS = f"""guests AS (
  SELECT author_name, '{'gst_'}' || CAST(row_number() OVER (ORDER BY f.source, f.topic_id, f.page_no, f.rec_no) - 1 AS VARCHAR) AS guest_id
  FROM (SELECT author_name, min({{'source': source, 'topic_id': topic_id, 'page_no': page_no, 'rec_no': rec_no}}) AS f
        FROM extracted WHERE ready AND source = '{SITE_SOURCES[2]}' AND {author_id_sql('source', 'author_href')} IS NULL
        GROUP BY author_name))"""
ORACLE["guest_ids"] = with_(FP, *EX, GUESTS, select="SELECT author_name, guest_id FROM guests")
ORACLE["name_carry"] = with_(FP, *EX, select=f"SELECT {FKS}, rec_no, role, author_name FROM extracted WHERE source = '{SITE_SOURCES[3]}'")
ORACLE["strip_colon"] = with_(FP, *EX, select=f"SELECT {FKS}, rec_no, text FROM extracted WHERE source = '{SITE_SOURCES[3]}'")
ORACLE["topic_id"] = with_(FP, select=f"SELECT {FKS}, {topic_id_sql('source', 'url')} AS url_topic_id FROM fpages")
ORACLE["author_id"] = with_(FP, *EX, select=f"""
SELECT {FKS}, rec_no, {author_id_sql('source', 'author_href')} AS author_id FROM extracted WHERE ready""")


def reject_sql(pages: str) -> list[str]:
    b, c = SITE_SOURCES[1], SITE_SOURCES[2]
    return [token_ctes(pages, FK, [], name="rt", ancestors=0), f"""rtitles AS (
  SELECT {FKS}, array_to_string(list_filter(list_transform(h1, lambda x: {strip('x')}), lambda x: x <> ''), '-') AS title_b,
         {strip("array_to_string(h1, ' ')")} AS title_c FROM (
    SELECT {FKS}, coalesce(list(text ORDER BY tpos) FILTER (WHERE kind = 'text' AND in_h1 > 0), []) AS h1
    FROM (SELECT *, {_inside(_pred('anc0', 'h1'), FKS)} AS in_h1 FROM rt) GROUP BY {FKS}))""", f"""rejected AS (
  SELECT {FKS}, url, CASE WHEN tid IS NULL THEN 'topic_id' ELSE 'title' END AS reason FROM (
    SELECT p.source, p.topic_id, p.page_no, p.url, {topic_id_sql('p.source', 'p.url')} AS tid,
           CASE WHEN p.source = '{b}' THEN t.title_b WHEN p.source = '{c}' THEN t.title_c END AS title
    FROM {pages} p LEFT JOIN rtitles t USING ({FKS}))
  WHERE tid IS NULL OR (source IN ('{b}', '{c}') AND coalesce(title, '') = ''))"""]


ALLPAGES = f"""allpages AS (
  SELECT source, topic_id, page_no, url, html FROM fpages
  UNION ALL SELECT '{SITE_SOURCES[2]}', 'page-' || CAST(page_id AS VARCHAR), 1, url, html FROM pages)"""
ORACLE["reject_pages"] = with_(FP, ALLPAGES, *reject_sql("allpages"), select="SELECT * FROM rejected")
XPOSTS = f"""xposts AS (
  SELECT source, topic_id, url, author_id, author_name, text, html, page_no,
         CAST(row_number() OVER (PARTITION BY source, topic_id ORDER BY page_no, rec_no) - 1 AS BIGINT) AS pos FROM (
    SELECT e.source, {topic_id_sql('e.source', 'p.url')} AS topic_id, p.url,
           coalesce(CASE WHEN e.source = '{SITE_SOURCES[3]}' THEN e.role ELSE {author_id_sql('e.source', 'e.author_href')} END,
                    CASE WHEN e.source = '{SITE_SOURCES[2]}' THEN g.guest_id END) AS author_id,
           e.author_name, e.text, e.html, e.page_no, e.rec_no
    FROM extracted e JOIN fpages p USING ({FKS})
    LEFT JOIN guests g ON e.author_name IS NOT DISTINCT FROM g.author_name
    WHERE e.ready AND NOT EXISTS (SELECT 1 FROM rejected r WHERE r.source = e.source AND r.topic_id = e.topic_id
                                  AND r.page_no = e.page_no)))"""
ORACLE["post_seq"] = with_(FP, *EX, GUESTS, *reject_sql("fpages"), XPOSTS,
                           select="SELECT source, topic_id, page_no, pos, author_id FROM xposts")
ORACLE["forum_dialog"] = with_(FP, *EX, GUESTS, *reject_sql("fpages"), XPOSTS,
                               quote_pairs_ctes(posts="xposts"), chain_ctes(posts="xposts"),
                               quote_dialog_cte(posts="xposts"), PAIRS, select=encode_select("pairs"))


# --------------------------------------------------------------------------
# sinks and streams: what is read back equals the batch result
# --------------------------------------------------------------------------
ORACLE["emit_order_two_speaker"] = with_(CONV, two_speaker_ctes(), select=f"""
SELECT {DK}, CAST(row_number() OVER (ORDER BY {DK}) - 1 AS BIGINT) AS line_no FROM v1""")
ORACLE["dialog_starter_chain_tail"] = with_(DOCS, chain_ctes(qpairs=None, tail=True), select="SELECT * FROM chain")
ORACLE["write_posts"] = with_(CONV, select="SELECT source, topic_id, url, author_id, author_name, text, html, pos FROM posts")
ORACLE["roundtrip_dataset"] = with_(*LINE_CTES[:-1], select="SELECT line FROM lines")
_QUOTED = """CASE WHEN regexp_matches(line, '[,"\\n\\r]') THEN '"' || replace(line, '"', '""') || '"' ELSE line END"""
ORACLE["write_dataset"] = with_(*LINE_CTES[:-1], select=f"SELECT unnest(string_split({_QUOTED}, chr(10))) AS value FROM lines")
ORACLE["write_split"] = with_(*LINE_CTES, SPLIT, select="SELECT split, unnest(string_split(line, chr(10))) AS value FROM splitted")
ORACLE["block_cache"] = ORACLE["pack_blocks"]
ORACLE["stream_ingest"] = ORACLE["write_posts"]
ORACLE["stream_extract"] = with_(FP, *EX, select=f"SELECT {_POST_OUT} FROM extracted WHERE ready")
ORACLE["stream_prompts"] = ORACLE["prompt_last5"]

ORACLE["dialog_starter_chain_buckets"] = ORACLE["dialog_starter_chain_docs"]
ORACLE["dialog_two_speaker_buckets"] = ORACLE["dialog_two_speaker_docs"]

ORACLE["field_map"] = ORACLE["field_join"].replace(
    "SELECT page_id, CAST(len(m) AS BIGINT) AS n_values, array_to_string(m, '-') AS joined,\n       list_filter(v, lambda x: x IS NOT NULL AND x <> '')[1] AS first_value FROM",
    "SELECT page_id, CAST(len(m) AS BIGINT) AS n_values FROM")
ORACLE["field_first"] = ORACLE["field_join"].replace(
    "SELECT page_id, CAST(len(m) AS BIGINT) AS n_values, array_to_string(m, '-') AS joined,\n       list_filter(v, lambda x: x IS NOT NULL AND x <> '')[1] AS first_value FROM",
    "SELECT page_id, list_filter(v, lambda x: x IS NOT NULL AND x <> '')[1] AS first_value FROM")
ORACLE["drop_header_rows"] = with_(CONV, select="""
SELECT source, topic_id, url, author_id, author_name, text, pos FROM posts WHERE coalesce(topic_id <> 'topic_id', true)""")
ORACLE["pair_runs"] = with_(DOCS, two_speaker_ctes(), select="SELECT source, topic_id, emit_k, speaker0_text, speaker1_text FROM v1")
for _r in ("a", "b", "c"):
    ORACLE[f"quotes_site_{_r}"] = with_(CONV, QP, select=f"""
SELECT source, topic_id, pos, k, speaker0_text, speaker1_text FROM qpairs WHERE rule = '{_r}'""")
ORACLE["dataset_union"] = with_(CONV, QP, chain_ctes(), quote_dialog_cte(), PAIRS,
                                doc_posts_cte("dposts"), chain_ctes(posts="dposts", qpairs=None, name="dchain"), select=f"""
SELECT {DK}, line, CAST(row_number() OVER (ORDER BY {DK}) - 1 AS BIGINT) AS line_no FROM (
  SELECT {DK}, line FROM ({encode_select('pairs')})
  UNION ALL SELECT {DK}, line FROM ({encode_select('dchain')}))""")
ORACLE["blocked_pages"] = with_(FP, LPAGES, select="""
SELECT url, 503 AS status FROM lpages WHERE strpos(url, 'b17.ru') > 0 AND substr(md5(url), 1, 1) IN ('0', '1')""")

ORACLE["dataset_tail"] = with_(*LINE_CTES[:-1], select=f"SELECT {DK}, line FROM lines ORDER BY {', '.join(c + ' DESC' for c in DK.split(', '))} LIMIT 5")

ORACLE["scan_post_exports"] = with_(CONV, select="""
SELECT author_id, author_name, text, topic_id, url, html, CAST(pos AS VARCHAR) AS pos,
       CASE source WHEN 'psy_su' THEN 'data_psy_su.csv' WHEN 'b17_ru' THEN 'data_b17_ru-1.csv'
                   WHEN 'psycheforum_ru' THEN 'data_psycheforum_ru-1.csv' ELSE 'data_psyhelp24_org.csv' END AS export
FROM posts""")


# --------------------------------------------------------------------------
# chains of replies that quotes start
# --------------------------------------------------------------------------
def _words(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '[ \\t\\n\\x0B\\f\\r\\x{{A0}}]+', ' ', 'g'))"


QUOTE_LINKS = f"""said AS (SELECT source, topic_id, pos, k, {_words('speaker0_text')} AS q, speaker1_text AS reply FROM qpairs),
held AS (SELECT source, topic_id, pos, ' ' || {_words('text')} || ' ' AS t FROM posts),
links AS (
  SELECT s.source, s.topic_id, s.pos, s.k, max(h.pos) AS cited_pos, any_value(s.reply) AS reply
  FROM said s JOIN held h ON h.source = s.source AND h.topic_id = s.topic_id AND h.pos < s.pos AND contains(h.t, ' ' || s.q || ' ')
  WHERE s.q <> '' GROUP BY ALL)"""
ORACLE["quote_links"] = with_(CONV, QP, QUOTE_LINKS, select="SELECT source, topic_id, pos, k, cited_pos FROM links")
ORACLE["quote_chains"] = with_(CONV, QP, QUOTE_LINKS, f"""
firsts AS (SELECT source, topic_id, pos, arg_min(cited_pos, k) AS parent, arg_min(reply, k) AS reply FROM links GROUP BY ALL),
walk AS (
  SELECT source, topic_id, pos, parent, parent AS root_pos, 1 AS depth FROM firsts
  UNION ALL
  SELECT w.source, w.topic_id, w.pos, w.parent, f.parent, w.depth + 1
  FROM walk w JOIN firsts f ON f.source = w.source AND f.topic_id = w.topic_id AND f.pos = w.root_pos),
tops AS (SELECT source, topic_id, pos, any_value(parent) AS parent, arg_max(root_pos, depth) AS root_pos, max(depth) AS depth FROM walk GROUP BY source, topic_id, pos)""",
    select=f"""
SELECT t.source, t.topic_id, t.root_pos, CAST(t.depth AS BIGINT) AS depth, t.pos, t.parent AS cited_pos, p.author_id, f.reply AS text
FROM tops t JOIN firsts f USING (source, topic_id, pos) JOIN posts p USING (source, topic_id, pos)
UNION ALL
SELECT p.source, p.topic_id, p.pos, CAST(0 AS BIGINT), p.pos, NULL, p.author_id, {clean('p.text')}
FROM posts p SEMI JOIN tops t ON p.source = t.source AND p.topic_id = t.topic_id AND p.pos = t.root_pos""").replace("WITH ", "WITH RECURSIVE ", 1)


# --------------------------------------------------------------------------
# harvest runs, dates, sketches, the map-only split, rolled-up yields
# --------------------------------------------------------------------------
ORACLE["stream_dedup_posts"] = with_(CONV, select="""
SELECT DISTINCT source, topic_id, url, CASE WHEN crawl = 3 AND d = '0' THEN text || ' (edited)' ELSE text END AS text
FROM (SELECT *, substr(md5(topic_id || '/' || CAST(pos AS VARCHAR)), 1, 1) AS d FROM posts),
     (SELECT unnest([1, 2, 3]) AS crawl) c
WHERE crawl = 1 OR (crawl = 2 AND d < '8') OR (crawl = 3 AND d < '4')""")
ORACLE["frontier_incremental"] = with_(FP, LPAGES, LINKS_CTE, RESOLVED, select=r"""
, runs AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS url, ((page_id % 3) + 3) % 3 AS run FROM lpages),
met AS (SELECT regexp_replace(l.abs_url, '#.*$', '') AS url, min(r.run) AS run FROM rlinks l JOIN runs r USING (page_id) GROUP BY 1),
got AS (SELECT url, min(run) AS run FROM runs GROUP BY url),
hosts AS (SELECT DISTINCT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)', 1)) AS host FROM lpages)
SELECT CAST(m.run AS BIGINT) AS run, m.url FROM met m LEFT JOIN got g USING (url)
WHERE m.url IS NOT NULL AND (g.run IS NULL OR g.run > m.run)
  AND lower(regexp_extract(m.url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:@]*)', 1)) IN (SELECT host FROM hosts)""")
ORACLE["topic_sessions"] = """
WITH e AS (SELECT user_id, ts, CASE WHEN coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) > 21600000000, true) THEN 1 ELSE 0 END AS new
           FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) - 1 AS session FROM e)
SELECT user_id, CAST(session AS BIGINT) AS session, min(ts) AS started, max(ts) AS ended, count(*) AS n_posts FROM s GROUP BY user_id, session"""
ORACLE["answers_as_of"] = """
WITH q AS (SELECT user_id, event_id, ts FROM events WHERE event_type IN ('view', 'signup') AND ts IS NOT NULL),
a AS (SELECT user_id, event_id, ts FROM events WHERE coalesce(event_type NOT IN ('view', 'signup'), true) AND ts IS NOT NULL),
m AS (SELECT a.user_id, a.event_id, a.ts, q.event_id AS question_id, q.ts AS asked,
             row_number() OVER (PARTITION BY a.event_id ORDER BY q.ts DESC, q.event_id DESC) AS nth
      FROM a JOIN q ON q.user_id IS NOT DISTINCT FROM a.user_id AND (q.ts < a.ts OR (q.ts = a.ts AND q.event_id < a.event_id))
      WHERE epoch_us(a.ts) - epoch_us(q.ts) <= 172800000000)
SELECT a.user_id, a.event_id, m.question_id, (epoch_us(a.ts) - epoch_us(m.asked)) / 1e6 AS waited
FROM a LEFT JOIN m ON m.event_id = a.event_id AND m.nth = 1"""
ORACLE["topic_count_sketch"] = with_(CONV, doc_posts_cte("dposts"), select="""
SELECT source, count(DISTINCT topic_id) AS n_topics, true AS within_bound, true AS merge_equals_rebuild
FROM (SELECT source, topic_id FROM posts UNION ALL SELECT source, topic_id FROM dposts) GROUP BY source""")
ORACLE["split_threshold"] = with_(CONV, QP, chain_ctes(), quote_dialog_cte(), PAIRS, LINES, select=f"""
, h AS (SELECT *, substr(md5(concat_ws(':', '1234', {", ".join(f"CAST({c} AS VARCHAR)" for c in DK.split(", "))})), 1, 4) AS b FROM lines),
bins AS (SELECT b, sum(count(*)) OVER (ORDER BY b) AS upto, sum(count(*)) OVER () AS total FROM h GROUP BY b),
cut AS (SELECT min(b) AS b FROM bins WHERE upto >= floor(total * 0.8 + 0.5))
SELECT {DK}, line, CASE WHEN h.b <= cut.b THEN 'train' ELSE 'test' END AS split FROM h, cut""")
ORACLE["topic_yield_rollup"] = with_(CONV, QP, chain_ctes(), quote_dialog_cte(), PAIRS, select=f"""
SELECT source, len1, kind, CAST(grouping(source, len1, kind) AS BIGINT) AS level, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM ({encode_select('pairs')}) GROUP BY ROLLUP (source, len1, kind)""")
ORACLE["entities_all"] = f"""
WITH m AS (SELECT conv_id, turn, '&' || replace(text, ' ', ' &') || '; &amp;lt; &' || replace(text, ' ', '; &') || '=&#' || CAST(turn * 37 + 120 AS VARCHAR)
                  || ' &#x' || CAST(turn * 37 + 120 AS VARCHAR) || ';' AS x FROM conversations)
SELECT conv_id, turn, {_decode('x')} AS as_text, {_decode('x', True)} AS as_attribute FROM m"""
