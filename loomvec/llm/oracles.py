"""SQL (DuckDB) for queries whose result it can express, built from the same parameters."""

from __future__ import annotations

from loomvec.llm.hash_tree import ROW_BYTES, Node
from loomvec.llm.mixing import Mix
from loomvec.llm.url_rules import ALLOW, Rule

_CRC_POLYNOMIAL = 0xEDB88320


def _crc_table() -> list[int]:
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (_CRC_POLYNOMIAL if byte & 1 else 0)
        table.append(byte)
    return table


def _shard_sql(node: Node) -> str:
    if node.shard is not None:
        return str(node.shard)
    if len(node.children) == 1:
        return _shard_sql(node.children[0])
    draws = ", ".join(
        f"-ln((CAST('0x' || substr(md5(key || '/{c.name}'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {1 << 52}::DOUBLE) / {c.weight}::DOUBLE"
        for c in node.children
    )
    cases = " ".join(f"WHEN {i + 1} THEN {_shard_sql(c)}" for i, c in enumerate(node.children))
    return f"CASE list_position([{draws}], list_min([{draws}])) {cases} END"


def shards_sql(tree: Node, after: Node) -> str:
    crc = (
        f"xor(list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda h: CAST('0x' || h AS BIGINT)), "
        f"lambda c, b: xor(c >> 8, ({_crc_table()}::BIGINT[])[(xor(c, b) & 255) + 1]), {0xFFFFFFFF}::BIGINT), {0xFFFFFFFF}::BIGINT)"
    )
    return f"""
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32) - 1 AS slot, grown_shard
    FROM (SELECT doc_id, CAST(strlen(text) + {ROW_BYTES} AS BIGINT) AS size, {crc} AS text_crc32,
                 CAST({_shard_sql(tree)} AS INTEGER) AS shard, CAST({_shard_sql(after)} AS INTEGER) AS grown_shard
          FROM (SELECT doc_id, coalesce(text, '') AS text, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key FROM documents))"""


def urls_sql(rules: tuple[Rule, ...], otherwise: str = ALLOW) -> str:
    longest = sorted(rules, key=lambda r: -len(r.text))
    fits = {r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in longest}
    rule = " ".join(f"WHEN {fits[r]} THEN '{r.text}'" for r in longest)
    verdict = " ".join(f"WHEN {fits[r]} THEN '{r.verdict}'" for r in longest)
    low = "translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} ELSE '{otherwise}' END AS verdict
    FROM (SELECT page_id, {low} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages)"""


def _named_sql(column: str, weights, other: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {weight}" for name, weight in weights.items())
    return f"CASE {column} {cases} ELSE {other} END" if cases else str(other)


def _fill_sql(children: str, parent: str, name: str) -> str:
    order = f"PARTITION BY {parent} ORDER BY most / weight, {name}"
    return f"""
      SELECT * EXCLUDE (isfull), CAST(CASE WHEN isfull THEN most ELSE least(most,
               CAST(given - sum(CASE WHEN isfull THEN most ELSE 0 END) OVER (PARTITION BY {parent}) AS BIGINT) * weight
               // greatest(CAST(sum(CASE WHEN isfull THEN 0 ELSE weight END) OVER (PARTITION BY {parent}) AS BIGINT), 1)) END AS BIGINT) AS budget
      FROM (SELECT *, coalesce(sum(most) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * weight
                      + most * sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= given * weight AS isfull
            FROM ({children}))"""


def mix_sql(mix: Mix) -> str:
    domain = " ".join(f"WHEN source IN ({', '.join(repr(s) for s in sources)}) THEN '{d}'" for d, sources in mix.domains.items())
    domains = f"""SELECT domain, 0 AS root, CAST(sum(tokens) * {mix.epochs} AS BIGINT) AS most,
        (SELECT CAST(sum(tokens) AS BIGINT) * {mix.share} // 100 FROM leaves) AS given, {_named_sql('domain', mix.domain_weights, mix.other)} AS weight
        FROM leaves GROUP BY domain"""
    languages = f"""SELECT domain, language, most, given, {_named_sql('language', mix.language_weights, mix.other)} AS weight
        FROM (SELECT domain, language, CAST(sum(tokens) * {mix.epochs} AS BIGINT) AS most FROM leaves GROUP BY ALL)
        JOIN (SELECT domain, budget AS given FROM by_domain) USING (domain)"""
    sources = f"""SELECT domain, language, source, tokens, tokens * {mix.epochs} AS most, given, {_named_sql('source', mix.source_weights, mix.other)} AS weight
        FROM leaves JOIN (SELECT domain, language, budget AS given FROM by_language) USING (domain, language)"""
    return f"""
    WITH docs AS (
      SELECT doc_id, CASE {domain} ELSE 'other' END AS domain, language, source, tokens FROM (
        SELECT doc_id, coalesce(source, 'none') AS source, coalesce(lang, 'none') AS language,
               CAST(ceil(strlen(text) / 4) AS BIGINT) AS tokens FROM documents) WHERE tokens > 0),
    leaves AS (SELECT domain, language, source, CAST(sum(tokens) AS BIGINT) AS tokens FROM docs GROUP BY ALL),
    by_domain AS ({_fill_sql(domains, 'root', 'domain')}),
    by_language AS ({_fill_sql(languages, 'domain', 'language')}),
    by_source AS ({_fill_sql(sources, 'domain, language', 'source')}),
    plan AS (SELECT domain, language, source, budget // tokens AS whole, budget % tokens AS rest FROM by_source),
    placed AS (
      SELECT docs.*, whole, rest,
             CAST('0x' || substr(md5('{mix.seed}/' || whole || '/' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS place
      FROM docs JOIN plan USING (domain, language, source)),
    taken AS (
      SELECT *, whole + CASE WHEN sum(tokens) OVER (PARTITION BY domain, language, source ORDER BY place) <= rest THEN 1 ELSE 0 END AS times
      FROM placed)
    SELECT doc_id, domain, language, source, tokens, CAST(unnest(range(times)) AS INTEGER) AS epoch FROM taken WHERE times > 0"""
