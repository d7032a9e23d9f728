"""DuckDB SQL for the registered queries of this folder that SQL can express."""

SQL: dict[str, str] = {}

SQL["op8_exact_dedup"] = """
WITH d AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents WHERE doc_id IS NOT NULL)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM d WINDOW same AS (PARTITION BY text)
"""

SQL["op4_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT DISTINCT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
           ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
  FROM d),
classes AS (SELECT list_sort(g) AS g, min(doc_id) AS node FROM s WHERE len(g) > 0 GROUP BY 1),
grams AS (SELECT node, len(g) AS n, unnest(g) AS gram FROM classes),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM grams a JOIN grams b ON a.gram = b.gram AND a.node < b.node
   AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a AS node, a AS root FROM links UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles,
       coalesce(r.root, c.node, s.doc_id) AS component_id,
       coalesce(r.root, c.node, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN classes c ON list_sort(s.g) = c.g LEFT JOIN roots r ON r.node = c.node
"""

_UNITS = (
    "'mm','cm','m','km','inch','inches','foot','feet','mile','miles','mg','g','kg','ton','tons','ml','l','ms','s',"
    "'sec','seconds','min','minutes','h','hours','days','weeks','months','years','percent','dollars','euros','cents'"
)


def _template(table: str, key: str) -> str:
    return rf"""
  SELECT *, list_transform(raw, lambda x, i:
      CASE WHEN regexp_matches(x, '^[0-9]') THEN '<num>'
           WHEN i > 1 AND NOT starts_with(x, low[i]) AND right(raw[i - 1], 1) NOT IN ('.', '!', '?') THEN '<name>'
           WHEN i > 1 AND regexp_matches(raw[i - 1], '^[0-9]') AND low[i] IN ({_UNITS}) THEN '<unit>'
           ELSE low[i] END) AS t
  FROM (SELECT DISTINCT id, text, raw, list_transform(raw, lambda x: lower(rtrim(x, '.!?'))) AS low
        FROM (SELECT {key} AS id, coalesce(text, '') AS text,
                     regexp_extract_all(coalesce(text, ''), '[\p{{L}}\p{{N}}]+(?:[.,][0-9]+)*[.!?]?') AS raw
              FROM {table} WHERE {key} IS NOT NULL)
        WHERE len(raw) > 0)"""


_CUT = """
  low[p + 1 : p + n] AS codes,
  list_prepend(CASE WHEN t[p + 1] = '<num>' THEN '<num>' ELSE low[p + 1] END, t[p + 2 : p + n]) AS template"""

SQL["op9_decontaminate"] = f"""
WITH doc0 AS ({_template("documents", "doc_id")}),
item0 AS ({_template("benchmark", "item_id")}),
item1 AS (SELECT id, text, p, n, {_CUT} FROM (
  SELECT *, least(len(raw), 8) AS n, unnest(range(0, len(raw) - least(len(raw), 8) + 1)) AS p FROM item0)),
item2 AS (SELECT *, 2 * len(list_filter(template, lambda t: t[1] <> '<')) >= n AS usable FROM item1),
item3 AS (SELECT *, NOT bool_or(usable) OVER (PARTITION BY id, text) AS literal FROM item2),
item AS (
  SELECT *, count(*) OVER (PARTITION BY id, text) AS windows, CASE WHEN literal THEN codes ELSE template END AS key
  FROM item3 WHERE usable OR literal),
doc1 AS (SELECT id, text, p, literal, {_CUT} FROM (
  SELECT doc0.*, n, literal, unnest(range(0, len(raw) - n + 1)) AS p
  FROM doc0, (SELECT DISTINCT n, literal FROM item) WHERE len(raw) >= n)),
doc AS (SELECT *, CASE WHEN literal THEN codes ELSE template END AS key FROM doc1),
found AS (
  SELECT d.id AS doc_id, d.text AS theirs_of, i.id AS item_id, i.text AS ours_of, windows, i.p AS place, d.p - i.p AS shift,
         i.literal, i.key AS kind, i.codes AS ours, d.codes AS theirs
  FROM doc d JOIN item i ON d.key = i.key AND d.literal = i.literal),
stepped AS (
  SELECT *, coalesce(shift - lag(shift) OVER (PARTITION BY doc_id, theirs_of, item_id, ours_of ORDER BY shift) > 2, false) AS new
  FROM found),
hits AS (
  SELECT *, sum(new::INT) OVER (PARTITION BY doc_id, theirs_of, item_id, ours_of ORDER BY shift) AS run FROM stepped),
covered AS (
  SELECT doc_id, theirs_of, item_id, ours_of, run, windows, count(DISTINCT place) AS matched FROM hits GROUP BY ALL),
slot AS (
  SELECT doc_id, theirs_of, item_id, ours_of, run, unnest(kind) AS kind, unnest(ours) AS ours, unnest(theirs) AS theirs
  FROM hits WHERE NOT literal),
counted AS (SELECT *, count(*) AS n FROM slot WHERE kind[1] = '<' GROUP BY ALL),
best AS (SELECT doc_id, theirs_of, item_id, ours_of, run, kind, ours, max(n) AS most, sum(n) AS n FROM counted GROUP BY ALL),
agree AS (SELECT doc_id, theirs_of, item_id, ours_of, run, sum(n) AS slots, sum(most) AS consistent FROM best GROUP BY ALL),
judged AS (
  SELECT c.doc_id, c.item_id, c.windows, c.matched, CAST(coalesce(consistent, 0) AS BIGINT) AS consistent,
         CAST(coalesce(slots, 0) AS BIGINT) AS slots
  FROM covered c LEFT JOIN agree a ON c.doc_id = a.doc_id AND c.theirs_of = a.theirs_of AND c.item_id = a.item_id
   AND c.ours_of = a.ours_of AND c.run = a.run),
held AS (SELECT * FROM judged WHERE (matched >= 0.5 * windows OR matched >= 20) AND consistent >= 0.8 * slots)
SELECT doc_id, item_id, matched, windows, slots, consistent FROM held
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, windows ORDER BY matched DESC, consistent DESC, slots DESC) = 1
"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL["op12_line_dedup"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_BLANKS}) AS key FROM l),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT any_value(k.doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE k.doc_id < keeper) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR k.doc_id >= keeper), '')) AS kept_sha256
FROM k LEFT JOIN repeated USING (key) GROUP BY r
"""

SQL["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER hardest AS INTEGER) AS rank, other AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
 AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW hardest AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER hardest <= 5
"""


def _after(state: int, cost: str, letter: str, written: str | None) -> str:
    """The prefix of a state with one more edit: cost, audit, repaired text; NULL stays NULL."""
    line = "" if written is None else f" || {'chr(10) || ' if state else ''}{written}"
    return (
        f"CASE WHEN s{state} IS NOT NULL THEN {{'c': s{state}.c + {cost}, 'a': s{state}.a || '{letter}', "
        f"'r': s{state}.r{line}}} END"
    )


def _least(offers: list[str]) -> str:
    """The cheapest offer, of equal ones that with the least audit."""
    return f"list_min([{', '.join(offers)}])"


_ROLE = {0: "'user'", 1: "'user'", 2: "'assistant'", 3: "'user'"}
_INTO = {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}


def _edited(target: int) -> str:
    offers = [_after(target, "4", "D", None)]
    for source, initial in _INTO[target]:
        kept = _after(source, "extra", "K", "role || ':' || text")
        offers.append(f"CASE WHEN NOT gone AND role[1] = '{initial}' THEN {kept} END")
        if initial != "s":
            offers.append(f"CASE WHEN NOT gone THEN {_after(source, '3 + extra', 'R', f'{_ROLE[source]} || chr(58) || text')} END")
    return _least(offers)


def _inserted(target: int) -> str:
    return _least([f"s{target}", *(_after(source, "3", "I", f"{_ROLE[source]} || chr(58)") for source, _ in _INTO[target])])


#: No prefix leads to the states after s, u and a yet; insertions lead to the last two.
_START = "{'c': 0::BIGINT, 'a': '', 'r': ''} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR) AS s1"

SQL["op11_conversation_repair"] = rf"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
hashed AS (
  SELECT *, xor(4294967295, list_reduce(
      list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
      lambda crc, b: list_reduce(
        [0, 1, 2, 3, 4, 5, 6, 7], lambda h, i: xor(h >> 1, (h & 1) * 3988292384), xor(crc, b)),
      4294967295)) % 20 AS hurt FROM raw),
hit AS (
  SELECT conv_id, turn, CASE WHEN hurt = 4 THEN 'user' ELSE role END AS role,
         CASE hurt WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN hurt = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed WHERE hurt <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         rtrim(text, {_BLANKS}) AS bare FROM hit),
again AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed),
judged AS (
  SELECT *, bare = '' AS blank, bare <> '' AND seen AS duplicate,
         bare <> '' AND NOT seen AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal FROM again),
edits AS (SELECT conv_id, i, role, text, blank OR duplicate AS gone, 3 * truncated::BIGINT AS extra FROM judged),
path AS (
  SELECT conv_id, 0::BIGINT AS i, s0, s1, s2, {_inserted(3)} AS s3
  FROM (SELECT conv_id, s0, s1, {_after(0, "3", "I", "'user:'")} AS s2, s1 AS s3 FROM (SELECT DISTINCT conv_id, {_START} FROM judged))
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {_inserted(3)} FROM (
    SELECT conv_id, i, s0, s1, {_inserted(2)} AS s2, s3 FROM (
      SELECT p.conv_id, e.i, {", ".join(f"{_edited(t)} AS s{t}" for t in range(4))}
      FROM path p JOIN edits e ON p.conv_id IS NOT DISTINCT FROM e.conv_id AND e.i = p.i + 1))),
ends AS (SELECT conv_id, arg_max(list_min([s0, s3]), i) AS best FROM path GROUP BY conv_id),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(duplicate) AS duplicate, count_if(truncated) AS truncated, count_if(illegal) AS illegal
  FROM judged GROUP BY conv_id)
SELECT o.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("gaps", "blank", "duplicate", "truncated", "illegal"))},
       coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(best.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN faults f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN ends n ON o.conv_id IS NOT DISTINCT FROM n.conv_id
"""
