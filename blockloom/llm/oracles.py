"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from blockloom.llm.quality_rules import BOILERPLATE

OP2 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
marked AS (
  SELECT *,
    (length(text) - length(replace(text, '\', '')))
      + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS in_text,
    (length(role) - length(replace(role, '\', '')))
      + (length(role) - length(replace(role, '</turn>', ''))) // 7
      + (length(role) - length(replace(role, ': ', ''))) // 2 AS in_role,
    regexp_matches(role, '\\.', 's') OR contains(role, '</turn>' || chr(10))
      OR contains(role, ': ') AS hard_role,
    regexp_matches(text, '\\.', 's') OR contains(text, '</turn>' || chr(10)) AS hard_text
  FROM rows
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(text)
    + CASE WHEN hard_role OR hard_text THEN in_text ELSE 0 END
    + CASE WHEN hard_role THEN in_role ELSE 0 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

_WORDS = r"""
split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') AS words
  FROM documents
)"""

OP3 = f"""
WITH {_WORDS},
windows AS (
  SELECT doc_id, k, array_to_string(words[k:k + 49], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS k FROM split)
),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
hit AS (
  SELECT DISTINCT doc_id, k + unnest(range(0, 50)) AS k
  FROM windows JOIN firsts USING (w) WHERE first < doc_id
),
kept AS (
  SELECT s.doc_id, s.k, s.word, h.k IS NOT NULL AS gone
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM split) s
  LEFT JOIN hit h ON h.doc_id = s.doc_id AND h.k = s.k
),
summed AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY k) FILTER (NOT gone), '') AS text
  FROM kept GROUP BY doc_id
)
SELECT split.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(summed.text, '')) AS kept_sha256
FROM split LEFT JOIN summed USING (doc_id)
"""

OP5 = rf"""
WITH {_WORDS},
sized AS (SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n_words FROM split),
windows AS (
  SELECT doc_id, k, array_to_string(words[k:k + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, n_words - 6)) AS k FROM sized)
),
again AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, k + unnest(range(0, 8)) AS k
    FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS c FROM windows) WHERE c > 1
  ) GROUP BY doc_id
),
lines AS (
  SELECT doc_id, line, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)
),
worded AS (
  SELECT doc_id, line, w, len(w) AS n, length(array_to_string(w, '')) AS chars,
    length(regexp_replace(line, '[^|»›·•]+', '', 'g')) AS separators,
    length(regexp_replace(line, '[^#*$%&|<>{{}}\[\]=_~^\\]+', '', 'g')) AS marks,
    length(regexp_replace(line, '[^\p{{Lu}}]+', '', 'g')) AS capitals,
    length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) AS letters,
    len(list_filter(range(2, len(w) + 1), lambda k: w[k] = w[k - 1])) AS stutter
  FROM lines WHERE len(w) > 0
),
ruled AS (
  SELECT doc_id, line, chars,
    (separators >= 3 AND 4 * separators >= n) OR 10 * marks > chars
    OR (regexp_matches(line, '![\x20\x09-\x0D](.*)!([\x20\x09-\x0D]|$)', 's') AND 10 * capitals > 6 * letters)
    OR (n >= 8 AND 10 * stutter >= 3 * n)
    OR (n >= 12 AND NOT regexp_matches(line, '[.!?…:;,。！？]'))
    OR (n <= 25 AND regexp_matches(line, '{{boilerplate}}')) AS failed
  FROM worded
),
summed AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
    coalesce(sum(chars) FILTER (failed), 0) AS lost
  FROM ruled GROUP BY doc_id
),
base AS (
  SELECT sized.doc_id, n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM sized JOIN documents USING (doc_id) LEFT JOIN again USING (doc_id) LEFT JOIN summed USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 10 * lost <= 4 * word_chars AS kept
FROM base
"""

_LOWER = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

OP8 = f"""
WITH docs AS (SELECT doc_id, {_LOWER} AS words FROM documents),
items AS (SELECT item_id, {_LOWER} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS width,
    array_to_string(words[k:k + least(13, len(words)) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS k
        FROM items WHERE len(words) > 0)
),
widths AS (SELECT DISTINCT width FROM item_windows),
doc_windows AS (
  SELECT doc_id, width, k, array_to_string(words[k:k + width - 1], ' ') AS w
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS k FROM docs, widths)
),
found AS (
  SELECT doc_id, item_id, k, d.width FROM doc_windows d JOIN item_windows i ON d.w = i.w AND d.width = i.width
),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, k + unnest(range(0, width)) AS k FROM found) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""


def _value(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _tree(name: str, leaves: str, key: str, levels: int) -> str:
    """Levels ``name``0, ``name``1, ... above rows (key, idx, h, n)."""
    made = [f"{name}0 AS ({leaves})"]
    for k in range(levels):
        made.append(
            f"""{name}{k + 1} AS (SELECT {key}, idx // 8 AS idx, sha256(string_agg(h, '' ORDER BY idx)) AS h,
            (any_value(n) + 7) // 8 AS n FROM {name}{k} WHERE n > 1 GROUP BY {key}, idx // 8)"""
        )
    return ",\n".join(made)


def _ascent(name: str, start: str, tree: str, key: str, levels: int) -> str:
    """Rows (row, key, i, f, proof) of ``start`` folded up through the levels of a tree."""
    made = [f"{name}0 AS ({start})"]
    for k in range(levels):
        made.append(
            f"""{name}{k + 1} AS (
            SELECT c.row, c.{key}, c.i // 8 AS i,
              CASE WHEN any_value(s.n) > 1
                THEN sha256(string_agg(CASE WHEN s.idx = c.i THEN c.f ELSE s.h END, '' ORDER BY s.idx))
                ELSE any_value(c.f) END AS f,
              any_value(c.proof) || coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx <> c.i), '') AS proof
            FROM {name}{k} c LEFT JOIN {tree}{k} s ON s.{key} = c.{key} AND s.idx // 8 = c.i // 8
            GROUP BY c.row, c.{key}, c.i)"""
        )
        # A tree that has ended has no such level: its rows stay as they are.
        made[-1] = made[-1].replace("CASE WHEN any_value(s.n) > 1", "CASE WHEN coalesce(any_value(s.n), 1) > 1")
    return ",\n".join(made)


def manifest_sql(levels: int = 7, top: int = 3) -> str:
    """The manifest of up to 8 ** levels rows a language, and 8 ** top languages."""
    fields = " || ".join(map(_value, ("doc_id", "source", "lang", "n_chars", "text")))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = fields.replace("CAST(text AS VARCHAR)", f"translate(text, '{upper}', '{upper.lower()}')")
    last = "\nUNION ALL ".join(f"SELECT shelf, h FROM l{k} WHERE n = 1" for k in range(levels + 1))
    return f"""
WITH bits AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(b))
),
hashed AS (
  SELECT doc_id, lang, sha256({fields}) AS leaf, sha256({changed}) AS lowered,
    coalesce(xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: ascii(d)::BIGINT)),
      lambda c, d: xor(c >> 8, t[(xor(c, d) & 255) + 1])), 4294967295) % 3 = 0, false) AS bad
  FROM documents, bits
),
shelves AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS shelf FROM (SELECT DISTINCT lang FROM hashed)),
leaves AS (
  SELECT h.*, shelf, row_number() OVER () AS row, count(*) OVER (PARTITION BY shelf) AS n,
    row_number() OVER (PARTITION BY shelf ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM hashed h JOIN shelves s ON h.lang IS NOT DISTINCT FROM s.lang
),
{_tree("l", "SELECT shelf, idx, leaf AS h, n FROM leaves", "shelf", levels)},
subroots AS ({last}),
{_tree("t", "SELECT 0 AS one, shelf AS idx, h, (SELECT count(*) FROM subroots) AS n FROM subroots", "one", top)},
{_ascent("a", "SELECT row, shelf, idx AS i, CASE WHEN bad THEN lowered ELSE leaf END AS f, '' AS proof FROM leaves", "l", "shelf", levels)},
{_ascent("b", f"SELECT row, 0 AS one, shelf AS i, f, proof FROM a{levels}", "t", "one", top)},
root AS (SELECT h FROM t{top} {" ".join(f"UNION ALL SELECT h FROM t{k} WHERE n = 1" for k in range(top))})
SELECT l.doc_id, l.leaf, s.h AS subroot, root.h AS root, sha256(b.proof) AS proof_sha256,
  b.f AS folded_root, b.f = root.h AS verified
FROM leaves l JOIN subroots s USING (shelf) JOIN b{top} b USING (row), root
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_chat": OP2,
        "op3_substrings": OP3,
        "op5_quality_rules": OP5.replace("{boilerplate}", BOILERPLATE),
        "op8_decontaminate": OP8,
        "op13_manifest": manifest_sql(),
    }
