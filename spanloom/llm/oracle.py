"""DuckDB SQL for the text queries that SQL can express on whole tables."""

from __future__ import annotations

from spanloom.llm import catalog, centroids, chat, personal, secrets


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chat() -> str:
    control = _text(catalog._CONTROL_TEXT)
    order = " OR ".join(
        f"(p = {_text(state)} AND role IN ({', '.join(map(_text, roles))}))"
        for state, roles in chat.ORDER.items()
    )
    trained = ", ".join(map(_text, chat.CHATML.trained))
    around = len(chat.OPEN) + 1 + len(chat.CLOSE) + 1
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {control}
  UNION ALL SELECT -1, 1, 'assistant', {control}
), placed AS (
  SELECT *, coalesce(lag(role) OVER w, '') AS p, lead(role) OVER w IS NULL AS is_last
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role IN ({trained})), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role IN ({trained})), ''))
    AS loss_sha256,
  sum({around} + length(replace(replace(replace(role, '\\', '\\\\'), '<|', '<\\|'), chr(10), '<\\n>'))
    + length(replace(replace(text, '\\', '\\\\'), '<|', '<\\|')))::BIGINT AS formatted_chars,
  bool_and(({order}) AND (NOT is_last OR role IN ({', '.join(map(_text, chat.FINAL))}))) AS valid
FROM placed GROUP BY conv_id
"""


def _secrets() -> str:
    kinds = []
    for i, (pattern, least) in enumerate(
        [(secrets.ASSIGN, secrets.MIN_ASSIGNED), (secrets.ACCESS, 0), (secrets.HEX, 0)]
    ):
        p = _text(pattern)
        value = f"regexp_extract(m, {p}, 2)" if i == 0 else "m"
        kinds.append(f"""
  SELECT row, {i} AS kind, start, start + length(m) AS stop, {value} AS value FROM (
    SELECT row, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
      coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS start
    FROM (SELECT row, regexp_extract_all(t, {p}) AS ms, string_split_regex(t, {p}) AS gaps FROM docs
          WHERE regexp_matches(t, {p}))
  ) WHERE length({value}) >= {least}""")
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(secrets.KINDS))
    shown = f"CASE kind {names} END || ':' || start || ':' || stop"
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, source, coalesce(source, '') AS owner,
    concat_ws('/', source, lang) AS repository, coalesce(text, '') AS t FROM documents
), base AS ({" UNION ALL ".join(kinds)}
), owned AS (
  SELECT value FROM base JOIN docs USING (row) GROUP BY value
  HAVING count(DISTINCT owner) < {secrets.EXAMPLE_OWNERS}
    AND count(DISTINCT repository) < {secrets.EXAMPLE_REPOSITORIES}
    AND len(list_distinct(string_split(value, ''))) >= {secrets.LIVE_CHARACTERS}
), spans AS (
  SELECT * FROM base
  UNION ALL
  SELECT DISTINCT row, 3 AS kind, stop - length(value), stop, value
  FROM base WHERE value IN (SELECT value FROM owned)
), joined AS (
  SELECT row, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
    count(*) FILTER (WHERE kind = 2) AS n_hex,
    string_agg({shown}, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
    string_agg({shown}, ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (row)
"""


def _any_case(words) -> str:
    """A pattern of some words, letters of ASCII in either case."""
    return "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word) for word in words
    )


def _personal() -> str:
    cues, schemes = _any_case(personal.CUES), _any_case(personal.SCHEMES)
    patterns = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        r"[0-9](?:[\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        cues,
        rf"(?:{schemes})[A-Za-z0-9._~%!$&'*+,;=:-]+@[A-Za-z0-9.-]*[A-Za-z0-9]",
    ]
    digits = "regexp_replace(m, '[^0-9]', '', 'g')"
    luhn = (
        f"list_sum(list_transform(range(length({digits})), lambda i: CASE WHEN i % 2 = 0 THEN d(i) "
        "WHEN d(i) > 4 THEN 2 * d(i) - 9 ELSE 2 * d(i) END)) % 10 = 0"
    ).replace("d(i)", f"substr({digits}, length({digits}) - i::BIGINT, 1)::INT")
    part = "length(ltrim(x, '0')) < 3 OR (length(ltrim(x, '0')) = 3 AND ltrim(x, '0') <= '255')"
    valid = [
        "true",
        f"list_bool_and(list_transform(string_split(m, '.'), lambda x: {part}))",
        f"length({digits}) BETWEEN {personal.CARD_DIGITS[0]} AND {personal.CARD_DIGITS[1]} AND {luhn}",
        f"length({digits}) BETWEEN {personal.PHONE_DIGITS[0]} AND {personal.PHONE_DIGITS[1]}",
        "true", "true",
    ]
    kinds = []
    for i, (pattern, check) in enumerate(zip(patterns, valid, strict=True)):
        p = _text(pattern)
        kinds.append(f"""
  SELECT row, {i} AS kind, start, start + length(m) AS stop FROM (
    SELECT row, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
      coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0)))::BIGINT AS start
    FROM (SELECT row, regexp_extract_all(t, {p}) AS ms, string_split_regex(t, {p}) AS gaps FROM docs
          WHERE regexp_matches(t, {p}))
  ) WHERE {check}""")
    names = " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(personal.KINDS))
    shown = f"CASE kind {names} END || ':' || start || ':' || stop"
    gap = f"[ :#=]{{1,{personal.CUE_GAP}}}"
    moved = "lower(substr(v, 5) || substr(v, 1, 4))"
    codes = (
        f"list_transform(string_split({moved}, ''), "
        "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN ascii(c) - 48 ELSE ascii(c) - 87 END)"
    )
    iban = (
        f"list_reduce(list_prepend(0, {codes}), "
        "lambda a, x: CASE WHEN x < 10 THEN (a * 10 + x) % 97 ELSE (a * 100 + x) % 97 END) = 1"
    )
    count = ", ".join(
        f"count(*) FILTER (WHERE kind = {i}) AS n_{personal.KINDS[i]}" for i in range(4)
    )
    counted = ", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in personal.KINDS[:4])
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents
), found AS ({" UNION ALL ".join(kinds)}
), behind AS (
  SELECT row, stop, regexp_extract(substr(t, (stop + 1)::BIGINT), '^{gap}') AS gap,
    regexp_extract(substr(t, (stop + 1)::BIGINT), '^{gap}([A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)', 1) AS w
  FROM found JOIN docs USING (row)
  WHERE kind = {personal.ACCOUNT} AND (start = 0 OR NOT regexp_matches(substr(t, start::BIGINT, 1), '[A-Za-z0-9]'))
), accounts AS (
  SELECT row, {personal.ACCOUNT} AS kind, stop + length(gap) AS start, stop + length(gap) + length(w) AS stop
  FROM (SELECT *, replace(w, '-', '') AS v FROM behind)
  WHERE length(v) BETWEEN {personal.ACCOUNT_LENGTH[0]} AND {personal.ACCOUNT_LENGTH[1]}
    AND length(regexp_replace(v, '[^0-9]', '', 'g')) >= {personal.ACCOUNT_DIGITS}
    AND (NOT regexp_matches(v, '^[A-Za-z]{{2}}[0-9]{{2}}.{{11}}') OR {iban})
), spans AS (
  SELECT * FROM found WHERE kind <> {personal.ACCOUNT} UNION ALL SELECT * FROM accounts
), joined AS (
  SELECT row, {count},
    string_agg({shown}, ',' ORDER BY kind, start) FILTER (WHERE kind < 4) AS base,
    string_agg({shown}, ',' ORDER BY kind, start) AS spans
  FROM spans GROUP BY row
)
SELECT doc_id, {counted}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (row)
"""


def _centroids() -> str:
    """Ten rounds as a chain of tables."""
    k, top = centroids.CLUSTERS, centroids.LARGEST
    parts = [f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda c:
    greatest(least(floor({centroids.SCALE} * c::DOUBLE), {top}), -{top})::BIGINT) AS x
  FROM embeddings
  WHERE len(embedding) = {centroids.WIDTH} AND NOT list_contains(list_transform(embedding,
    lambda c: c IS NULL OR NOT isfinite(c::DOUBLE)), true)
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY sha256('{centroids.SALT}' || vec_id) NULLS LAST, x) - 1)::INT AS cluster,
    x AS c FROM vectors QUALIFY cluster < {k}
)"""]
    distance = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(centroids.ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
  SELECT row, vec_id, x, cluster, {distance} AS distance FROM vectors CROSS JOIN c{i}
  QUALIFY row_number() OVER (PARTITION BY row ORDER BY distance, cluster) = 1
)""")
        if i < centroids.ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, o.c) AS c FROM c{i} o LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT cluster, i, sum(v) AS s, count(*) AS n
      FROM (SELECT cluster, unnest(x) AS v, unnest(range(len(x))) AS i FROM a{i}) GROUP BY cluster, i
    ) GROUP BY cluster
  ) m USING (cluster)
)""")
    last = centroids.ROUNDS
    return ", ".join(parts) + f"""
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{last} JOIN c{last} USING (cluster)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_chat": _chat(), "op10_secrets": _secrets(), "op12_personal": _personal(),
        "op13_centroids": _centroids(),
    }
