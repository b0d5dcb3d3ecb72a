"""SQL of keyword search, written down directly rather than efficiently."""

from __future__ import annotations


def tokens(text: str, gap: str = r"[^\p{L}\p{N}]+") -> str:
    return f"list_filter(string_split_regex(lower({text}), '{gap}'), lambda t: t <> '')"


def values(rows) -> str:
    def literal(v):
        if v is None:
            return "NULL"
        if isinstance(v, (list, tuple)):
            return "[" + ", ".join(literal(x) for x in v) + "]"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows) + ")"


def search_ctes(
    docs: str,
    fields: list[str],
    queries,
    weights: dict[str, int] | None = None,
    prefix: list[str] = (),
    infix: dict[str, str] | None = None,
    num_typos: int = 0,
    typos_on_digits: bool = False,
    typo_threshold: int = 1,
    drop_threshold: int = 0,
    match_type: str = "max_score",
    ranking_tokens: int = 1000000,
    exact: bool = True,
    position: bool = False,
    num_fields: bool = False,
    synonyms: str | None = None,
    synonym_prefix: bool = False,
    synonym_typos: int = 0,
    stemming: str | None = None,
    name: str = "hits",
) -> str:
    """Common table expressions ending in ``name``; ``queries`` is a list of pairs or a SELECT.

    ``synonyms`` selects (term, expansion), ``stemming`` selects (word, root).
    """
    weights, infix = weights or {}, infix or {}
    p = f"{name}_"
    source = queries if isinstance(queries, str) else f"SELECT * FROM {values(queries)} v(query_id, q)"
    field_list = "[" + ", ".join(f"'{f}'" for f in fields) + "]"
    each = " UNION ALL ".join(f"SELECT id, '{f}' AS field, {tokens(f)} AS toks FROM {p}docs" for f in fields)
    weight = "CASE field " + " ".join(f"WHEN '{f}' THEN {weights.get(f, 1)}" for f in fields) + " END"

    single = "CAST(0 AS HUGEINT) AS alt, 0 AS word_no, 1 AS n_words"
    cands = [
        f"SELECT query_id, slot, field, {single}, token, 0 AS cost, 0 AS infix "
        f"FROM {p}qt, (SELECT unnest({field_list}) AS field)"
    ]
    if prefix:
        names = ", ".join(f"'{f}'" for f in prefix)
        cands.append(
            f"SELECT query_id, slot, field, {single}, v.token, 0, 0 FROM {p}qt q JOIN {p}vocab v "
            f"ON starts_with(v.token, q.token) WHERE slot = n - 1 AND field IN ({names})"
        )
    for f, mode in infix.items():
        if mode != "off":
            cands.append(
                f"SELECT query_id, slot, field, {single}, v.token, 0, {1 if mode == 'fallback' else 0} FROM {p}qt q "
                f"JOIN {p}vocab v ON contains(v.token, q.token) WHERE field = '{f}'"
            )
    if num_typos:
        digits = "" if typos_on_digits else " AND NOT regexp_matches(q.token, '[0-9]')"
        bound = f"least({num_typos}, CASE WHEN length(q.token) >= 7 THEN 2 WHEN length(q.token) >= 4 THEN 1 ELSE 0 END)"
        cands.append(
            f"SELECT query_id, slot, field, {single}, v.token, levenshtein(q.token, v.token), 0 FROM {p}qt q "
            f"JOIN {p}vocab v ON levenshtein(q.token, v.token) BETWEEN 1 AND {bound} WHERE true{digits}"
        )
    extra = ""
    if synonyms:
        lookup = "list_slice(q.qwords, q.slot + 1, q.slot + len(s.tw)) = s.tw"
        if synonym_typos:
            lookup = f"({lookup} OR (len(s.tw) = 1 AND levenshtein(s.tw[1], q.token) <= {synonym_typos}))"
        extra = (
            f"{p}syn AS (SELECT DISTINCT {tokens('term')} AS tw, {tokens('expansion')} AS ew FROM ({synonyms})),\n"
            f"{p}alts AS (SELECT DISTINCT query_id, unnest(range(slot, slot + len(tw))) AS slot, "
            f"CAST(hash([[CAST(slot AS VARCHAR)], tw, ew]) AS HUGEINT) AS alt, ew FROM {p}qt q JOIN {p}syn s ON {lookup}),\n"
            f"{p}altw AS (SELECT query_id, slot, alt, len(ew) AS n_words, unnest(ew) AS token, "
            f"unnest(range(len(ew))) AS word_no FROM {p}alts),\n"
        )
        cands.append(
            f"SELECT query_id, slot, field, alt, word_no, n_words, token, 0, 0 FROM {p}altw, "
            f"(SELECT unnest({field_list}) AS field)"
        )
        if synonym_prefix:
            cands.append(
                f"SELECT query_id, slot, field, alt, word_no, n_words, v.token, 0, 0 FROM {p}altw a "
                f"JOIN {p}vocab v ON starts_with(v.token, a.token)"
            )
    if stemming:
        extra += f"{p}stem AS (SELECT DISTINCT word, root FROM ({stemming})),\n"
        cands.append(
            f"SELECT query_id, slot, field, {single}, v.token, 0, 0 FROM {p}qt q LEFT JOIN {p}stem a ON q.token = a.word "
            f"JOIN ({p}vocab v LEFT JOIN {p}stem b ON v.token = b.word) "
            f"ON coalesce(a.root, q.token) = coalesce(b.root, v.token)"
        )
    score = "100000000 * tm + 1000000 * (9 - least(9, fc))"
    if exact:
        score += " + 100000 * CAST(ftext = qtext AS INTEGER)"
    if position:
        score += " + 100 * (999 - least(999, fp))"
    if match_type == "max_score":
        doc_score, doc_weight = "max(s)", "max(s * 1000 + w) % 1000"
    elif match_type == "max_weight":
        doc_score, doc_weight = "max(w * 1000000000000 + s) % 1000000000000", "max(w)"
    else:
        doc_score, doc_weight = "sum(s * w)", "max(w)"
    bonus = " + least(99, nf)" if num_fields else ""
    return f"""
{p}queries AS ({source}),
{p}docs AS {docs},
{p}ft AS ({each}),
{p}ftext AS (SELECT id, field, array_to_string(toks, ' ') AS ftext FROM {p}ft),
{p}post AS (SELECT id, field, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM {p}ft),
{p}vocab AS (SELECT DISTINCT field, token FROM {p}post),
{p}qt AS (SELECT query_id, toks AS qwords, len(toks) AS n, array_to_string(toks, ' ') AS qtext, unnest(toks) AS token,
          unnest(range(len(toks))) AS slot FROM (SELECT query_id, {tokens('q')} AS toks FROM {p}queries)),
{p}qn AS (SELECT DISTINCT query_id, n, qtext FROM {p}qt),
{extra}{p}cand AS ({' UNION ALL '.join(cands)}),
{p}m AS (SELECT query_id, id, field, slot, alt, n_words, min(pos) AS pos, min(cost) AS cost,
          min(CASE WHEN infix = 0 THEN cost END) AS pcost, min(infix) AS infix
         FROM {p}cand JOIN {p}post USING (field, token) GROUP BY ALL HAVING count(DISTINCT word_no) = n_words),
{p}fs AS (SELECT query_id, id, field, slot, min(pos) AS pos, min(cost) AS cost FROM {p}m GROUP BY ALL),
{p}f AS (SELECT query_id, id, field, count(*) FILTER (slot < {ranking_tokens}) AS tm,
          sum(cost) FILTER (slot < {ranking_tokens}) AS fc, min(pos) FILTER (slot < {ranking_tokens}) AS fp
         FROM {p}fs GROUP BY ALL),
{p}sc AS (SELECT query_id, id, field, {weight} AS w, CASE WHEN tm > 0 THEN {score} END AS s
         FROM {p}f JOIN {p}ftext USING (id, field) JOIN {p}qn USING (query_id)),
{p}d AS (SELECT query_id, id, CAST(coalesce({doc_score}, 0) AS BIGINT) AS base,
          CAST(coalesce({doc_weight.replace('max(w)', 'max(CASE WHEN s IS NOT NULL THEN w END)')}, 0) AS INTEGER) AS weight,
          count(*) AS nf FROM {p}sc GROUP BY ALL),
{p}ds AS (SELECT query_id, id, slot, min(pcost) AS pcost, min(infix) AS infix FROM {p}m GROUP BY ALL),
{p}run AS (SELECT *, row_number() OVER (PARTITION BY query_id, id ORDER BY slot) - 1 AS i,
          CASE WHEN infix = 0 THEN row_number() OVER (PARTITION BY query_id, id, infix ORDER BY slot) - 1 END AS j FROM {p}ds),
{p}lv AS (SELECT query_id, id, count(*) AS matched_any, count(*) FILTER (infix = 0) AS matched,
          coalesce(sum(pcost), 0) AS cost, count(*) FILTER (i = slot) AS lead_any, count(*) FILTER (j = slot) AS lead
         FROM {p}run GROUP BY ALL),
{p}all AS (SELECT query_id, id, base{bonus} AS score, weight, CAST(nf AS INTEGER) AS matched_fields,
          CAST(cost AS INTEGER) AS typo_cost, n,
          CASE WHEN matched = n THEN 0 WHEN matched_any = n OR lead = 0 THEN 1 ELSE 0 END AS infix,
          CAST(CASE WHEN matched = n OR matched_any = n THEN 0 WHEN lead > 0 THEN n - lead ELSE n - lead_any END AS INTEGER) AS dropped
         FROM {p}d JOIN {p}lv USING (query_id, id) JOIN {p}qn USING (query_id)),
{p}ok AS (SELECT * FROM {p}all WHERE dropped < n AND (dropped = 0 OR {drop_threshold} > 0)),
{p}cnt AS (SELECT query_id, infix, dropped, typo_cost, count(*) AS c FROM {p}ok GROUP BY ALL),
{p}bef AS (SELECT *, coalesce(sum(c) OVER (PARTITION BY query_id ORDER BY infix, dropped, typo_cost
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM {p}cnt),
{name} AS (SELECT o.query_id, o.id, CAST(o.score AS BIGINT) AS score, o.weight, o.matched_fields, o.typo_cost, o.dropped
         FROM {p}ok o JOIN {p}bef b ON o.query_id = b.query_id AND o.infix = b.infix AND o.dropped = b.dropped
         AND o.typo_cost = b.typo_cost
         WHERE before < least(CASE WHEN o.infix > 0 THEN 1 ELSE 4e18 END,
                              CASE WHEN o.dropped > 0 THEN {drop_threshold} ELSE 4e18 END,
                              CASE WHEN o.typo_cost > 0 THEN {typo_threshold} ELSE 4e18 END))"""


HIT_COLUMNS = "query_id, id, score, weight, matched_fields, typo_cost, dropped"


def search(docs: str, fields: list[str], queries, select: str | None = None, **options) -> str:
    """A whole statement: all hits, or ``select`` over the CTE ``hits``."""
    return f"WITH {search_ctes(docs, fields, queries, **options)}\n{select or f'SELECT {HIT_COLUMNS} FROM hits'}"


def top(order: str, n: int = 10, columns: str = "", source: str = "hits", after: int = 0) -> str:
    """First ``n`` per query of a list."""
    extra = f", {columns}" if columns else ""
    return (
        f"SELECT query_id, id{extra}, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id "
        f"ORDER BY {order}, id) AS INTEGER) AS rank FROM {source}) WHERE rank > {after} AND rank <= {n}"
    )
