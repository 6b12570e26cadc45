"""DuckDB equivalents of the registered queries, by the same names."""

from __future__ import annotations

from sluice import schemas as S

ORACLE: dict[str, str] = {}


def _first_per_key(table: str, key: str, order: list[str], columns: list[str]) -> str:
    """First row per key by ``order``, then by the other columns; NULLs last."""
    rest = [c for c in columns if c != key and c not in order]
    by = ", ".join(f"{c} nulls last" for c in [*order, *rest])
    return (
        f"select {', '.join(columns)} from {table} where {key} is not null "
        f"qualify row_number() over (partition by {key} order by {by}) = 1"
    )


# Sources and sinks give back what was written.

_LINES = """
select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus,
       strftime(l_shipdate, '%Y-%m-%d') as l_shipdate
from lineitem"""
_ORDERS = "select * replace (strftime(o_orderdate, '%Y-%m-%d') as o_orderdate) from orders"

ORACLE["scan_csv"] = _LINES
ORACLE["scan_csv_dates"] = _LINES
ORACLE["scan_parquet"] = _LINES
ORACLE["scan_csv_multiline"] = "select * from documents"
ORACLE["scan_csv_split_records"] = "select * from documents"
ORACLE["scan_csv_bad_cells"] = f"""
select * replace (case when o_orderpriority <> '1-URGENT' then o_totalprice end as o_totalprice),
       case when o_orderpriority = '1-URGENT'
            then concat_ws(',', o_orderkey, o_custkey, o_orderstatus, 'n/a', o_orderdate, o_orderpriority)
       end as bad_line
from ({_ORDERS})"""
ORACLE["scan_json_lines"] = "select * from customer"
_UNBROKEN = """
case when o_orderpriority <> '1-URGENT' then {0} end as {0}"""
_BROKEN_LINES = ", ".join(
    _UNBROKEN.format(c)
    for c in ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
)
ORACLE["scan_json_lines_malformed"] = f"""
select {_BROKEN_LINES}, null::bigint as o_custkey from ({_ORDERS})"""
ORACLE["scan_json_lines_broken_text"] = f"""
select {_BROKEN_LINES}, null::bigint as o_custkey,
       case when o_orderpriority = '1-URGENT'
            then '{{"o_orderkey": ' || o_orderkey || ', "o_orderpriority' end as bad_line
from ({_ORDERS})"""
ORACLE["json_dict_pivot"] = """
select o_orderkey::varchar as id, o_custkey || '|' || o_orderpriority as related_ids from orders
union all
select o_orderkey || '/note', null from orders"""
ORACLE["reshape_recommendations"] = """
select format('{{"id":"{}","related ids":["{}","{}"]}}', o_orderkey, o_custkey, o_orderpriority)
       as line
from orders
union all
select format('{{"id":"{}/note","related ids":null}}', o_orderkey) from orders"""
ORACLE["edges_exploded"] = """
select o_orderkey::varchar as id, o_custkey::varchar as related_id from orders
union all
select o_orderkey::varchar, o_orderpriority from orders"""

ORACLE["sink_parquet_overwrite"] = _ORDERS
ORACLE["publish_append"] = "select * from customer union all select * from customer"
ORACLE["publish_overwrite"] = "select * from customer"
ORACLE["publish_set_versions"] = """
select version::int as version, table_name, case when table_name = 'customer' and version = 2 then 2 else 1 end * n as n_rows, d as n_distinct
from (select unnest([0, 1, 2]) as version), (
  select 'customer' as table_name, count(*) as n, count(distinct c) as d from customer c
  union all select 'nation', count(*), count(distinct n) from nation n)"""
ORACLE["publish_report"] = """
select 'customer' as table_name, 'overwrite' as mode, count(*) as n_rows, 'ok' as status
from customer
union all select 'lineitem', 'overwrite', null, 'failed'
union all select 'part', 'overwrite', null, 'failed'
union all select 'balances', 'overwrite', null, 'failed'
union all select 'orders', 'append', count(*), 'ok' from orders"""

ORACLE["conform_target"] = f"""
select * replace (o_orderkey::varchar as o_orderkey, o_custkey::integer as o_custkey),
       null::double as tempo
from ({_ORDERS})"""
ORACLE["conversion_violations"] = """
select c_custkey, 'c_acctbal' as column_name, c_acctbal::varchar as value,
       trunc(c_acctbal)::integer::varchar as converted
from customer where trunc(c_acctbal) <> c_acctbal"""
ORACLE["key_violations"] = """
select l_orderkey, l_linenumber, count(*) as n_rows
from lineitem group by all having count(*) > 1"""
ORACLE["length_violations"] = """
select doc_id, 'text' as column_name, length(text)::integer as n_chars, 50 as max_chars
from documents where length(text) > 50
union all
select doc_id, 'source', length(source)::integer, 4 from documents where length(source) > 4"""

# Cleaning

ORACLE["require_key"] = """
select event_id, event_type as key, value from events where event_type <> 'error'"""
ORACLE["dedupe_keys"] = "select distinct l_orderkey, l_linenumber from lineitem"
ORACLE["dedupe_first_by"] = """
select * from documents qualify row_number() over (partition by text order by doc_id) = 1"""
ORACLE["dedupe_pruned"] = """
select o_custkey, o_orderkey, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by o_orderkey) = 1"""
ORACLE["dedupe_hot_key"] = f"""
select * from ({_LINES})
qualify row_number() over (
    partition by l_returnflag, l_linestatus
    order by l_extendedprice, l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
             l_discount, l_tax, l_shipdate) = 1"""
ORACLE["clean_entity"] = """
select * from documents where source <> 'src0'
qualify row_number() over (partition by text order by doc_id) = 1"""
ORACLE["fill_nulls"] = """
select l_orderkey,
       coalesce(nullif(l_linenumber, 7), 0) as l_linenumber,
       case when l_discount = 0 then -1.0 else l_discount end as l_discount,
       case when l_tax = 0 then -1.0 else l_tax end as l_tax,
       nullif(l_quantity, 1.0) as l_quantity,
       coalesce(nullif(l_returnflag, 'R'), 'Unknown') as l_returnflag,
       coalesce(nullif(l_linestatus, 'O'), 'Unknown') as l_linestatus
from lineitem"""

# Shaping

ORACLE["project_columns"] = "select l_suppkey, l_orderkey, l_quantity from lineitem"
ORACLE["parse_json_array"] = """
select p_partkey, '[''' || replace(p_name, ' ', ''', ''') || ''']' as tags,
       len(string_split(p_name, ' '))::integer as n_tags,
       array_to_string(string_split(p_name, ' '), '|') as tag
from part"""
ORACLE["explode_json_array"] = """
select p_partkey, unnest(string_split(p_name, ' ')) as tag from part"""

# A track as a row with the list of ids it names; NULL where that text is broken.
_TRACKS = """
select l_orderkey || '-' || l_linenumber as id,
       l_returnflag || '/' || l_linestatus as name,
       l_quantity::integer as popularity,
       l_suppkey::integer as duration_ms,
       (l_returnflag = 'R')::integer as explicit,
       '[' || chr(39) || l_returnflag || chr(39) || ', ' || chr(39) || l_linestatus || chr(39) || ']' as artists,
       case when l_tax = 0 then '[]'
            when l_discount = 0 then '[''' || l_partkey || ''','
            else '[''' || l_partkey || ''', ''' || l_orderkey || ''']' end as id_artists,
       strftime(l_shipdate, '%Y-%m-%d') as release_date,
       l_discount as danceability, l_tax as energy, l_linenumber as key,
       -l_quantity as loudness, (l_linestatus = 'O')::integer as mode,
       l_discount * 2 as speechiness, l_tax * 2 as acousticness,
       l_discount + l_tax as instrumentalness, l_extendedprice / 2 as liveness,
       l_quantity / 2 as valence, l_extendedprice as tempo,
       l_linenumber + 1 as time_signature,
       case when l_tax = 0 then []
            when l_discount = 0 then null
            else [l_partkey::varchar, l_orderkey::varchar] end as listed
from lineitem"""
# The listed ids, or a single NULL where there are none.
_OUTER_LISTED = "case when len(listed) > 0 then listed else [null::varchar] end"
_ARTISTS = """
select p_partkey::varchar as id, p_retailprice as followers,
       '[''' || p_type || ''']' as genres, p_name as name, p_size as popularity
from part"""
_RECOMMENDATIONS = """
select o_orderkey::varchar as id, o_custkey || '|' || o_orderpriority as related_ids
from orders"""
_CLEAN_TRACKS = _first_per_key(f"({_TRACKS})", "id", ["name"], [*S.TRACKS.names, "listed"])

ORACLE["artist_track"] = f"select id, unnest(listed) as artist_id from ({_TRACKS})"
ORACLE["artist_track_outer"] = f"""
select id, unnest({_OUTER_LISTED}) as artist_id from ({_TRACKS})"""
ORACLE["unlisted_rows"] = f"""
select id, id_artists from ({_TRACKS}) where coalesce(len(listed), 0) = 0"""
# Unicode's title case of the letter eszett is "Ss"; SQL's upper leaves it.
ORACLE["normalize_text"] = """
select doc_id,
       array_to_string(list_transform(string_split(lower(text), ' '), lambda w:
           case w[1] when 'ß' then 'Ss' else upper(w[1]) end || w[2:]), ' ') as text,
       upper(lang) as lang, upper(source) as source, n_chars
from documents"""

# Enrichment and the music tables

_LINE_PART = """
select l_orderkey, l_linenumber, {key} as l_partkey, p_name as part_name,
       p_retailprice as part_price
from lineitem left join part on l_partkey = p_partkey and p_type <> 'ECONOMY'"""

ORACLE["left_enrich"] = _LINE_PART.format(key="p_partkey")
ORACLE["left_enrich_salted"] = _LINE_PART.format(key="p_partkey")
ORACLE["left_enrich_keep_key"] = _LINE_PART.format(key="l_partkey")

_MASTER = """
with t as (select id, name, popularity, danceability, energy, tempo,
                  unnest({listed}) as artist_id from ({tracks})),
     a as ({artists}),
     r as ({recommendations})
select t.id as track_id, t.name as track_name, t.popularity as track_popularity,
       {key} as artist_id, a.name as artist_name, a.followers, a.genres,
       a.popularity as artist_popularity, {measures} r.related_ids
from t left join a on t.artist_id = a.id left join r on {key} = r.id"""


def _master(key: str, listed: str = "listed", measures: str = "") -> str:
    return _MASTER.format(
        tracks=_CLEAN_TRACKS,
        artists=_ARTISTS,
        recommendations=_RECOMMENDATIONS,
        key=key,
        listed=listed,
        measures=measures,
    )


ORACLE["master_table"] = _master("a.id")
ORACLE["master_table_salted"] = _master("a.id")
ORACLE["master_table_outer"] = _master("a.id", _OUTER_LISTED)
ORACLE["master_table_outer_salted"] = _master("t.artist_id", _OUTER_LISTED)
ORACLE["master_table_keep_key"] = _master("t.artist_id")
ORACLE["track_metadata"] = f"""
select {', '.join(S.TRACK_METADATA_COLUMNS)} from ({_CLEAN_TRACKS})"""
ORACLE["artist_metadata"] = f"select {', '.join(S.ARTIST_METADATA_COLUMNS)} from ({_ARTISTS})"

_COUNT = "select '{0}' as table_name, 'overwrite' as mode, count(*) as n_rows, 'ok' as status from"
ORACLE["music_run"] = " union all ".join(
    [
        f"{_COUNT.format('master_table')} ({_master('a.id')})",
        f"""select 'recommendations_exploded', 'overwrite', 2 * count(*), 'ok'
            from ({_RECOMMENDATIONS})""",
        f"""{_COUNT.format('artist_track')}
            (select unnest(listed) from ({_CLEAN_TRACKS}))""",
        f"{_COUNT.format('track_metadata')} ({_CLEAN_TRACKS})",
        f"{_COUNT.format('artist_metadata')} ({_ARTISTS})",
    ]
)

ORACLE["music_run_dictionary"] = ORACLE["music_run"]
ORACLE["music_published_master"] = _master("a.id", measures="danceability, energy, tempo,")
ORACLE["music_published_edges"] = """
select o_orderkey::varchar as id, o_custkey::varchar as related_id from orders
union all
select o_orderkey::varchar, o_orderpriority from orders"""
ORACLE["music_published_artist_track"] = f"""
select id, unnest(listed) as artist_id from ({_CLEAN_TRACKS})"""
ORACLE["music_published_track_metadata"] = ORACLE["track_metadata"]
ORACLE["music_published_artist_metadata"] = ORACLE["artist_metadata"]

# Products

_PRODUCTS = """
select p_brand || '/' || nullif(p_size, 1) as product_id,
       nullif(p_name, 'small ring') as product_name,
       nullif(p_type, 'ECONOMY') as category,
       lower(p_type) as subcategory,
       case when p_type <> 'PROMO' then p_retailprice end as price,
       nullif(p_size, 7) as stock,
       nullif(p_brand, 'Brand#1') as brand,
       string_split(p_name, ' ')[1] as color,
       p_size::varchar as size,
       case when p_size > 10 then p_retailprice / 2 end as rating,
       p_partkey::integer as reviews
from part"""
_PRODUCT_CLEAN = f"""
select product_id, coalesce(product_name, 'Unknown') as product_name,
       coalesce(category, 'Unknown') as category,
       coalesce(subcategory, 'Unknown') as subcategory,
       coalesce(price, 0.0) as price, coalesce(stock, 0) as stock,
       coalesce(brand, 'Unknown') as brand, coalesce(color, 'Unknown') as color,
       coalesce(size, 'Unknown') as size, coalesce(rating, 0.0) as rating,
       coalesce(reviews, 0) as reviews
from ({_first_per_key(f"({_PRODUCTS})", "product_id", ["product_name"], S.PRODUCTS.names)})"""
_PRODUCT_MASTER = f"""
select * replace (
    array_to_string(list_transform(string_split(lower(product_name), ' '),
                                   lambda w: upper(w[1]) || w[2:]), ' ') as product_name,
    upper(category) as category, upper(subcategory) as subcategory)
from ({_PRODUCT_CLEAN})"""

ORACLE["product_clean"] = _PRODUCT_CLEAN
ORACLE["product_master"] = _PRODUCT_MASTER
ORACLE["products_run"] = _PRODUCT_MASTER
ORACLE["product_metadata"] = f"""
select {', '.join(S.PRODUCT_METADATA_COLUMNS)} from ({_PRODUCT_CLEAN})"""
ORACLE["pricing_stock"] = f"""
select {', '.join(S.PRICING_STOCK_COLUMNS)} from ({_PRODUCT_CLEAN})"""
