"""SQL forms of the sample views, put in front of the queries that name them."""

from __future__ import annotations

import re

from webgraph_spark.plans.sample_views import ROBOTS_TEXTS
from webgraph_spark.schemas import PAGE_TYPES


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TYPES = ", ".join(_literal(code) for code in PAGE_TYPES)
_ROBOTS = " ".join(
    f"WHEN {rest} THEN replace({_literal(text)}, '{{d}}', domain)" for rest, text in enumerate(ROBOTS_TEXTS)
)


def _encode(text: str, safe: str) -> str:
    out = f"url_encode({text})"
    for char in safe:
        out = f"replace({out}, '%{ord(char):02X}', '{char}')"
    return out


def _canonical(href: str, site: str) -> str:
    joined = (
        f"trim(CASE WHEN starts_with({href}, 'www') THEN {site} || 'http://' || {href} "
        f"WHEN starts_with({href}, '/') THEN {site} || substr({href}, 2) ELSE {site} || {href} END)"
    )
    absolute = f"CASE WHEN starts_with({href}, 'http') THEN {href} ELSE {joined} END"
    page = (
        f"{href} <> '' AND (starts_with({href}, 'http') OR (NOT contains({href}, 'javascript:') "
        f"AND NOT contains({href}, 'mailto:') AND NOT contains({href}, 'tel:') "
        f"AND NOT starts_with({href}, '#') AND {href} <> '/'))"
    )
    stripped = f"string_split({absolute}, '#')[1]"
    return f"CASE WHEN {page} THEN {_encode(stripped, ':/&?+=')} END"


_WORDS = r"list_filter(regexp_split_to_array(text, '[\s\x0b\x1c-\x1f]+'), lambda w: w <> '')"

_HREF_FORMS = (
    "[{'kind': 0, 'href': NULL}, {'kind': 1, 'href': ''}, {'kind': 2, 'href': '/'}, {'kind': 3, 'href': '#' || url}, "
    "{'kind': 4, 'href': 'javascript:' || url}, {'kind': 5, 'href': 'mailto:' || url}, {'kind': 6, 'href': 'tel:' || url}, "
    "{'kind': 7, 'href': replace(url, 'http', '')}, {'kind': 8, 'href': replace(url, 'http', 'www')}, "
    "{'kind': 9, 'href': url}, {'kind': 10, 'href': url || ' é,%20*~'''}]"
)


def _shingles(source: str) -> str:
    # Distinct windows of ten words per text.
    return f"""SELECT DISTINCT id, list_aggregate(list_slice(w, i, i + 9), 'string_agg', ' ') AS shingle FROM (
        SELECT id, w, unnest(range(1, len(w) - 8)) AS i FROM (SELECT id, {_WORDS} AS w FROM {source}) WHERE len(w) >= 10)"""


def _marks(source: str, threshold: str, name: str) -> dict[str, str]:
    """The sequential rule: one step per page that has an earlier similar page."""
    return {
        f"{name}_first": f"SELECT id, text, html, min(id) OVER (PARTITION BY sha256(html)) AS first_id FROM {source}",
        f"{name}_unique": f"SELECT id, text FROM {name}_first WHERE id = first_id",
        f"{name}_sh": _shingles(f"{name}_unique"),
        f"{name}_len": f"SELECT id, count(*) AS n FROM {name}_sh GROUP BY id",
        f"{name}_pairs": f"""SELECT p, q, ct, nq, ct / (np + nq - ct) AS j FROM (
            SELECT a.id AS p, b.id AS q, count(*) AS ct FROM {name}_sh a JOIN {name}_sh b ON a.shingle = b.shingle AND b.id < a.id
            GROUP BY a.id, b.id) JOIN (SELECT id AS p, n AS np FROM {name}_len) USING (p)
            JOIN (SELECT id AS q, n AS nq FROM {name}_len) USING (q)""",
        f"{name}_suspects": f"""SELECT p, list({{'q': q, 'j': j}} ORDER BY ct DESC, nq, q) AS l,
            row_number() OVER (ORDER BY p) AS rn FROM {name}_pairs GROUP BY p HAVING max(j) > {threshold}""",
        f"{name}_steps": f"""SELECT 0::BIGINT AS rn, []::BIGINT[] AS near UNION ALL
            SELECT s.rn, CASE WHEN list_filter(s.l, lambda x: NOT list_contains(t.near, x.q))[1].j > {threshold}
              THEN list_append(t.near, s.p) ELSE t.near END
            FROM {name}_steps t JOIN {name}_suspects s ON s.rn = t.rn + 1""",
        f"{name}_near": f"SELECT unnest(near) AS id FROM {name}_steps WHERE rn = (SELECT max(rn) FROM {name}_steps)",
        f"{name}_best": f"""SELECT s.p AS id, list_filter(s.l, lambda x: NOT list_contains(t.near, x.q))[1] AS best
            FROM {name}_suspects s, {name}_steps t WHERE t.rn = (SELECT max(rn) FROM {name}_steps)
            AND list_contains(t.near, s.p)""",
        name: f"""SELECT f.id, CASE WHEN f.id <> f.first_id THEN 'exact' WHEN b.id IS NOT NULL THEN 'near' ELSE 'kept' END AS status,
            CASE WHEN f.id <> f.first_id THEN f.first_id ELSE b.best.q END AS matched_id,
            CASE WHEN f.id <> f.first_id THEN 1.0::DOUBLE ELSE b.best.j END AS similarity
            FROM {name}_first f LEFT JOIN {name}_best b ON b.id = f.id""",
    }


_TEXT = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script\s*>', '', 'g'), "
    r"'(?is)<style\b[^>]*>.*?</style\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[A-Za-z/!?][^>]*>', '', 'g')"
)
_DECODED = (
    f"regexp_replace(replace(replace(replace({_TEXT}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;?', '&', 'g')"
)

VIEWS: dict[str, str] = {
    "page_v": r"""SELECT page_id AS id, url, html, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1)) || '://'
        || regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) || '/' AS domain, """
    + _encode(r"regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*', '')", "/")
    + " AS robots_path FROM pages",
    "site_v": f"""SELECT id, domain, CASE id % 8 {_ROBOTS} END AS robots_content
        FROM (SELECT min(id) AS id, domain FROM page_v GROUP BY domain)""",
    "typed_page_v": f"""SELECT id, url, domain, ([{_TYPES}])[(id % 7 + 1)::INTEGER] AS page_type_code,
        CASE WHEN id % 11 <> 0 THEN TIMESTAMP '2024-01-01' + to_seconds(id) END AS added_at_time FROM page_v""",
    "state_v": """SELECT p.id, p.url, p.domain, p.page_type_code, p.added_at_time,
        CASE WHEN p.page_type_code = 'FRONTIER' AND p.id % 2 = 0 THEN TRUE END AS active_in_crawler,
        CASE WHEN p.page_type_code <> 'FRONTIER' THEN s.id END AS site_id
        FROM typed_page_v p JOIN site_v s ON s.domain = p.domain""",
    "href_v": """SELECT id AS from_page, domain, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM (
        SELECT id, domain, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM page_v)""",
    "cand_v": f"SELECT * FROM (SELECT from_page, pos, {_canonical('href', 'domain')} AS to_url FROM href_v) WHERE to_url IS NOT NULL",
    "odd_href_v": f"SELECT id, domain, f.kind AS kind, f.href AS href FROM (SELECT id, domain, unnest({_HREF_FORMS}) AS f FROM page_v)",
    "canonical_v": f"SELECT id, kind, {_canonical('href', 'domain')} AS canonical FROM odd_href_v",
    "created_v": """SELECT (SELECT max(page_id) FROM pages) + row_number() OVER (ORDER BY from_page, pos) AS id, url FROM (
        SELECT to_url AS url, min((from_page, pos)) AS first, min((from_page, pos))[1] AS from_page, min((from_page, pos))[2] AS pos
        FROM cand_v WHERE to_url NOT IN (SELECT url FROM pages) GROUP BY to_url)""",
    "edge_url_v": "SELECT DISTINCT p.url AS source, c.to_url AS target FROM cand_v c JOIN pages p ON p.page_id = c.from_page",
    "graph_v": """SELECT DISTINCT l_orderkey % n AS from_page, l_partkey % n AS to_page
        FROM lineitem, (SELECT count(*) AS n FROM pages)""",
    "fetch_v": """SELECT event_id AS page_id, user_id AS site_id, ts AS accessed_time,
        CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS status,
        CASE event_type WHEN 'view' THEN 'text/html; charset=utf-8' WHEN 'click' THEN 'image/png' WHEN 'purchase' THEN 'application/pdf'
          WHEN 'signup' THEN 'application/pdf; charset=x' END AS content_type,
        event_id % 13 <> 0 AS robots_ok, CASE WHEN event_id % 17 = 0 THEN 'timeout' END AS error,
        CASE WHEN event_id % 5 <> 0 THEN props END AS html, event_id % 3 = 0 AS duplicate FROM events""",
    "typed_v": """SELECT *, CASE WHEN NOT robots_ok THEN 'DISALLOWED' WHEN error IS NOT NULL OR status >= 400 THEN 'ERROR'
        WHEN contains(coalesce(content_type, ''), 'text/html') THEN
          CASE WHEN html IS NULL THEN 'ERROR' WHEN duplicate THEN 'DUPLICATE' ELSE 'HTML' END
        WHEN contains(coalesce(content_type, ''), 'image') THEN 'IMAGE' ELSE 'BINARY' END AS page_type_code FROM fetch_v""",
    "body_v": """SELECT t.*, strlen(repeat(props, (event_id % 5)::INTEGER))::BIGINT AS data_size
        FROM typed_v t JOIN events ON event_id = page_id WHERE event_id % 19 <> 0""",
    "line_v": """SELECT site_id, line_no, key, value, CASE key WHEN '' THEN 'E' WHEN 'user-agent' THEN 'U' ELSE 'R' END AS kind FROM (
        SELECT site_id, line_no, CASE WHEN line = '' THEN '' ELSE lower(trim(split_part(content, ':', 1))) END AS key,
          trim(substr(content, instr(content, ':') + 1)) AS value FROM (
          SELECT id AS site_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no,
            trim(split_part(unnest(lines), '#', 1)) AS content FROM (SELECT id, string_split(robots_content, chr(10)) AS lines FROM site_v))
        WHERE line = '' OR contains(content, ':'))
        WHERE key IN ('', 'user-agent', 'disallow', 'allow', 'crawl-delay', 'request-rate')""",
    "counted_v": """SELECT * FROM (SELECT *, last_value(CASE WHEN kind <> 'R' THEN kind END IGNORE NULLS) OVER
        (PARTITION BY site_id ORDER BY line_no) AS opener FROM line_v) WHERE kind <> 'R' OR opener = 'U'""",
    "grouped_v": """SELECT *, sum(opens) OVER (PARTITION BY site_id ORDER BY line_no) AS group_no FROM (
        SELECT *, CASE WHEN kind = 'U' AND coalesce(lag(kind) OVER (PARTITION BY site_id ORDER BY line_no), 'E') <> 'U'
        THEN 1 ELSE 0 END AS opens FROM counted_v)""",
    "rule_v": """SELECT g.site_id, g.group_no, g.line_no AS rule_no, g.key,
        CASE WHEN key IN ('allow', 'disallow') THEN """
    + _encode("value", "/")
    + """ END AS path, key = 'allow' OR value = '' AS allow,
        CASE WHEN key = 'crawl-delay' AND regexp_full_match(value, '[0-9]+') THEN value::INTEGER END AS delay, d.is_default
        FROM grouped_v g JOIN (SELECT site_id, group_no, bool_or(kind = 'U' AND value = '*') AS is_default, bool_or(kind = 'R') AS used
          FROM grouped_v WHERE kind <> 'E' GROUP BY 1, 2) d ON d.site_id = g.site_id AND d.group_no = g.group_no
        WHERE g.kind = 'R' AND d.used""",
    "text_v": "SELECT doc_id AS id, text, text AS html FROM documents",
    "bench_v": "SELECT item_id AS id, text FROM benchmark",
    "doc_shingle_v": _shingles("text_v"),
    "bench_shingle_v": _shingles("bench_v"),
    "doc_length_v": f"""SELECT t.id, len({_WORDS}) AS n_words, coalesce(s.n, 0) AS n FROM text_v t
        LEFT JOIN (SELECT id, count(*) AS n FROM doc_shingle_v GROUP BY id) s ON s.id = t.id""",
    "page_text_v": f"SELECT page_id AS id, {_DECODED} AS text, html FROM pages",
    "page_shingle_v": _shingles("page_text_v"),
    "page_length_v": """SELECT p.page_id AS id, coalesce(s.n, 0) AS n FROM pages p
        LEFT JOIN (SELECT id, count(*) AS n FROM page_shingle_v GROUP BY id) s ON s.id = p.page_id""",
}


def _definitions(sql: str) -> tuple[str, dict[str, str]]:
    known = dict(VIEWS)
    for base, source in (("page_marks_v", "page_text_v"), ("marks_v", "text_v")):
        for threshold in set(re.findall(rf"\b{base}(@[0-9.]+)?", sql)):
            name = f"{base}_at_{threshold[1:].replace('.', '')}" if threshold else base
            known.update(_marks(source, threshold[1:] or "0.95", name))
            if threshold:
                sql = sql.replace(f"{base}{threshold}", name)
    return sql, known


def ctes(sql: str) -> str:
    """``sql`` with the definitions of all views it names, directly or through others."""
    sql, known = _definitions(sql)
    order: list[str] = []

    def visit(text: str, above: tuple[str, ...] = ()) -> None:
        for name in re.findall(r"\b[a-z_0-9]+\b", text):
            if name in known and name not in order and name not in above:
                visit(known[name], (*above, name))
                order.append(name)

    visit(sql)
    if not order:
        return sql
    head = ", ".join(f"{name} AS ({known[name]})" for name in order)
    body = re.sub(r"^\s*WITH RECURSIVE ", ", ", sql)
    return f"WITH RECURSIVE {head} {body}"
