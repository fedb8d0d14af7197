"""DuckDB SQL for the operators that SQL can express (the independent side of the comparison; Spark never runs it)."""

from __future__ import annotations

from metassoc.llm.chat import Template
from metassoc.llm.secret_scan import RULES


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def chat_sql(template: Template = Template()) -> str:
    """Hashes straight from the turns; a control string, with or without backslashes after its first character, costs the
    formatted text one more character."""
    control = r"[<\[]\\*(s>|/s>|INST\]|/INST\])"
    around = len(template.open + template.head + template.close)
    extra = " + ".join(f"len(regexp_extract_all({c}, {_text(control)}))" for c in ("role", "text"))
    return f"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
whole AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = {_text(template.loss_role)}), '') AS loss,
    sum(length(role) + length(text) + {around} + {extra}) AS chars
  FROM said GROUP BY conv_id)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256,
  CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM whole"""


def secrets_sql() -> str:
    """Every rule's matches by RE2; places from the lengths of matches and of what lies between them."""
    parts = []
    for r, rule in enumerate(RULES):
        pattern = _text(rule.java)
        parts.append(f"""SELECT doc_id, {r} AS rule, {_text(rule.kind)} AS kind, {str(rule.base).lower()} AS base, {rule.least} AS least,
  regexp_extract_all(t, {pattern}, 0) AS f, regexp_extract_all(t, {pattern}, {rule.group}) AS g, string_split_regex(t, {pattern}) AS s
FROM docs WHERE regexp_matches(t, {pattern})""")
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE rule = {r}) AS BIGINT) AS n_{x.kind}" for r, x in enumerate(RULES) if x.base)
    zero = ", ".join(f"coalesce(n_{x.kind}, 0) AS n_{x.kind}" for x in RULES if x.base)
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(parts)}),
placed AS (SELECT doc_id, rule, kind, base, least, unnest(range(1, len(f) + 1)) AS i, f, g, s FROM found),
ends AS (SELECT doc_id, rule, kind, base, length(f[i]) AS n, length(g[i]) >= least AS ok,
    list_sum(list_transform(f[1:i], lambda x: length(x))) + list_sum(list_transform(s[1:i], lambda x: length(x))) AS e FROM placed),
spans AS (SELECT doc_id, rule, base, e - n AS b, kind || ':' || CAST(CAST(e - n AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR) AS said
  FROM ends WHERE ok),
per AS (SELECT doc_id, {counts},
    sha256(coalesce(string_agg(said, ',' ORDER BY b, rule) FILTER (WHERE base), '')) AS base_sha256,
    string_agg(said, ',' ORDER BY b, rule) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, {zero}, coalesce(base_sha256, sha256('')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN per p ON d.doc_id = p.doc_id"""


EXACT_SQL = """WITH d AS (SELECT CAST(doc_id AS BIGINT) AS doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, keep_id, group_size, d.doc_id = keep_id AS kept, d.text_sha256 FROM d JOIN g ON d.text_sha256 = g.text_sha256"""
