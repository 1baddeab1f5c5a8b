"""SQL counterparts of the queries, computed straight from the given tables.

None of them goes through JSON: what a query reads out of messages and landed
bodies, the SQL derives from the rows these were built from.
"""

from __future__ import annotations

from catalogue.binding import EVENTS_PER_PAGE, GENERATION_TS

# The feed, its order, and the table it leads to.
FEED = """
    with trade as (
        select event_id, ts, user_id, event_type, value,
               cast(regexp_extract(props, '([0-9]+)', 1) as int) % 20 + 1 as k,
               event_id // 10 as msg
        from events
    ), feed as (
        select *,
               case when k % 3 = 0 then 11 else 6 end as quality,
               'Item ' || k as market,
               '7656119' || lpad(cast(user_id as varchar), 10, '0') as steamid,
               case when user_id % 2 = 0 then 'sell' else 'buy' end as intent,
               case event_type when 'error' then 'listing-delete' when 'signup' then 'listing-other'
                    else 'listing-update' end as event,
               epoch_us(max(ts) over (partition by msg)) // 1000 as ord_time,
               cast(msg % 4 as int) as ord_partition, msg // 4 as ord_offset, event_id % 10 as ord_pos
        from trade
    ), ev as (
        select *,
               case when intent = 'sell' then '440_' || (user_id * 100 + k)
                    else '440_' || steamid || '_' || md5(market) end as id,
               (ord_time // 86400000 + 1) * 86400000 as touched
        from feed
    )"""

FIELDS = """
    id, steamid, k as item_defindex, quality as item_quality_id, intent, 440 as appid,
    value as metal, user_id % 5 as keys,
    case when event_id % 4 = 0 then null else value * 2 end as raw_value,
    case when event_id % 4 = 0 then null else value || ' ref' end as short_value,
    cast(null as varchar) as long_value, 'trade ' || event_id as details,
    epoch_us(ts) // 1000000 * 1000 as listed_at,
    case when k in (6, 12) then null else market end as market_name,
    'active' as status, 'agent' as user_agent_client, 'user ' || user_id as user_name,
    user_id % 9 = 0 as user_premium, true as user_online, cast(null as boolean) as user_banned,
    cast(null as varchar) as user_trade_offer_url, event_id % 2 = 0 as item_tradable, true as item_craftable,
    '#7D6D00' as item_quality_color,
    case when event_id % 2 = 0 then 'Spark' end as item_particle_name,
    case when event_id % 2 = 0 then 'std' end as item_particle_type,
    epoch_us(ts) // 1000000 * 1000 as bumped_at,
    case when event_id % 5 = 0 then cast(k as varchar) end as spell_ids,
    case when event_id % 6 = 0 then cast(user_id % 90 as varchar) end as strange_part_ids,
    case when event_id % 7 = 0 then k + 1000 end as paint_id,
    case when event_id % 7 = 0 then 'Blue' end as paint_name,
    case when event_id % 7 = 0 then '#0000FF' end as paint_color,
    cast(null as varchar) as paint_secondary_hex"""

_ORD = "ord_time desc, ord_partition desc, ord_offset desc, ord_pos desc"

STORED = FEED + f""", last_update as (
        select {FIELDS} from ev where event = 'listing-update'
        qualify row_number() over (partition by id order by {_ORD}) = 1
    ), last_event as (
        select id, event = 'listing-delete' as is_deleted, touched as updated_at
        from ev where event <> 'listing-other'
        qualify row_number() over (partition by id order by {_ORD}) = 1
    ), first_update as (
        select id, min(touched) as created_at from ev where event = 'listing-update' group by id
    ), stored as (
        select * from last_update join last_event using (id) join first_update using (id)
    )"""

# What is on the market, as the landed responses tell it.
MARKET = STORED + f""", market as (
        select *, event_id // {EVENTS_PER_PAGE} as page,
               user_id % 7 = 3 and (intent = 'sell' or k in (1, 16)) as gone,
               user_id % 13 = 5 and k in (2, 17) as no_id,
               case when user_id % 3 = 0 then 2 else 1 end as n_matches,
               user_id % 11 in (5, 6) or user_id % 17 = 4 as unreadable
        from ev where event_type in ('view', 'signup')
        qualify row_number() over (partition by id order by event_id) = 1
    ), snapshot as (
        select *, row_number() over (partition by market, page order by event_id) - 1 as pos
        from market
    ), names as (
        select item_defindex as k, item_quality_id as quality, arg_max(market_name, (updated_at, id)) as market_name
        from stored where market_name is not null group by all
    ), req as (
        select distinct k, quality, 'r' || lpad(cast(k as varchar), 2, '0') as request_id,
               case k % 4 when 0 then 'FULL' when 1 then 'BUY_ONLY' when 2 then 'SELL_ONLY' else 'SINGLE_ID' end as effective_type,
               case when k % 5 = 0 then 1 when k in (8, 18) then 0 end as max_size
        from ev
    ), named as (
        select r.*, n.market_name,
               r.effective_type = 'SELL_ONLY' and coalesce(max_size <= 0, false) as refused,
               r.effective_type in ('FULL', 'BUY_ONLY') as wants_buy,
               r.effective_type in ('FULL', 'SELL_ONLY') and coalesce(max_size > 0, true) as wants_sell,
               case when n.market_name is null then null
                    when r.k in (4, 13) or n.market_name not in (select market from market) then 'null'
                    else 'ready' end as snapshot_state
        from req r left join names n using (k, quality)
    ), buy_row as (
        select n.request_id, s.* from named n join snapshot s on s.market = n.market_name
        where n.wants_buy and n.snapshot_state = 'ready' and s.intent = 'buy'
    ), sell_row as (
        select n.request_id, n.max_size, s.*,
               case when s.unreadable then 'unreadable_inventory'
                    when s.n_matches > n.max_size then 'inventory_size' end as skip_reason
        from named n join snapshot s on s.market = n.market_name
        where n.wants_sell and n.snapshot_state = 'ready' and s.intent = 'sell'
    ), sell_hit as (
        select * from sell_row where skip_reason is null and not gone
    ), buy_stop as (
        select request_id, min((page, pos)) as buy_until from buy_row where gone or no_id group by request_id
    ), sell_stop as (
        select request_id, min((page, pos)) as sell_until from sell_hit where no_id group by request_id
    ), verdict as (
        select n.*, b.buy_until,
               n.wants_sell and n.snapshot_state = 'ready' and not (n.wants_buy and b.buy_until is not null) as sell_runs,
               s.sell_until
        from named n left join buy_stop b using (request_id) left join sell_stop s using (request_id)
    ), judged as (
        select *,
               case when refused then 'refused: max_inventory_size'
                    when effective_type = 'FULL' and market_name is null then 'no_market_name'
                    when effective_type = 'FULL' and snapshot_state = 'null' then 'null_snapshot'
                    when wants_buy and buy_until is not null then 'buy_without_detail'
                    when sell_runs and sell_until is not null then 'detail_without_id' end as failure,
               wants_buy or wants_sell as for_item
        from verdict
    ), item_stored as (
        select n.request_id, t.id, t.steamid
        from named n join stored t on t.item_defindex = n.k and t.item_quality_id = n.quality
        where not t.is_deleted and n.snapshot_state = 'ready' and (n.wants_buy or n.wants_sell)
    ), stale_buy as (
        select i.* from item_stored i join judged j using (request_id)
        where j.wants_buy and j.buy_until is null and length(i.id) - length(replace(i.id, '_', '')) = 2
          and not exists (from buy_row b where b.request_id = i.request_id and b.id = i.id and not b.gone and not b.no_id)
    ), stale_sell as (
        select i.* from item_stored i join judged j using (request_id)
        where j.sell_runs and j.sell_until is null and length(i.id) - length(replace(i.id, '_', '')) = 1
          and not exists (from sell_hit h where h.request_id = i.request_id and h.id = i.id and not h.no_id)
          and not exists (from sell_row x where x.request_id = i.request_id and x.steamid = i.steamid
                          and x.skip_reason is not null)
    ), stale_pick as (
        select item_defindex as k, min(id) as stale_id from stored
        where not is_deleted and id not in (select id from market) group by 1
    ), found_pick as (
        select k, min(id) as found_id from market where not gone group by k
    ), single as (
        select n.request_id, n.k,
               case when n.k = 15 then 'none_1'
                    else coalesce(case when n.k = 7 then f.found_id else s.stale_id end, 'none_' || n.k) end as listing_id
        from named n left join stale_pick s using (k) left join found_pick f using (k)
        where n.effective_type = 'SINGLE_ID'
    ), single_event as (
        select s.request_id, m.id, 'listing-update' as event, m.steamid, 'trade ' || m.event_id as details
        from single s join market m on m.id = s.listing_id and not m.gone and not m.no_id
        union all
        select s.request_id, s.listing_id, 'listing-delete', t.steamid, null
        from single s join stored t on t.id = s.listing_id and not t.is_deleted
        where not exists (from market m where m.id = s.listing_id and not m.gone and not m.no_id)
    ), reconciled as (
        select b.request_id, 0 as stage, b.page, b.pos, b.id, 'listing-update' as event, b.steamid,
               'trade ' || b.event_id as details
        from buy_row b join judged j using (request_id)
        where j.buy_until is null or (b.page, b.pos) < j.buy_until
        union all
        select request_id, 1, 0, 0, id, 'listing-delete', steamid, null from stale_buy
        union all
        select h.request_id, 2, h.page, h.pos, h.id, 'listing-update', h.steamid, 'trade ' || h.event_id
        from sell_hit h join judged j using (request_id)
        where j.sell_runs and (j.sell_until is null or (h.page, h.pos) < j.sell_until)
        union all
        select request_id, 3, 0, 0, id, 'listing-delete', steamid, null from stale_sell
        union all
        select request_id, case event when 'listing-update' then 0 else 1 end, 0, 0, id, event, steamid, details
        from single_event
    ), outcome as (
        select request_id, effective_type,
               case when failure is null then 'processed' else 'failed' end as status,
               coalesce(failure, case when for_item and market_name is null then 'no_market_name'
                                      when for_item and snapshot_state = 'null' then 'null_snapshot' end) as reason,
               (select count(*) from reconciled r where r.request_id = j.request_id and event = 'listing-update') as updates,
               (select count(*) from reconciled r where r.request_id = j.request_id and event = 'listing-delete') as deletes
        from judged j
    ), candidate as (
        select request_id, 'buy' as part, id as listing_id from buy_row
        union all
        select request_id, 'sell', '440_' || unnest(case when user_id % 3 = 0
               then [9000000000 + user_id * 100 + k, user_id * 100 + k] else [user_id * 100 + k] end)
        from (select distinct request_id, user_id, k from sell_row where skip_reason is null)
        union all
        select request_id, 'single', listing_id from single
    ), need as (
        select request_id, 'snapshot' as endpoint, market_name as key from named
        where market_name is not null and not refused and (wants_buy or wants_sell)
        union
        select request_id, 'inventory', steamid from sell_row
        union
        select request_id, 'detail', listing_id from candidate where listing_id is not null
    )"""

_EVENT = f"request_id, stage, page, pos, id, event, {GENERATION_TS} as generation_timestamp, steamid, details"


# Every item that a search may ask for, in the order in which it asks.
_TRIES = """, tries as (
    select request_id, steamid, generate_subscripts(items, 1) as pos, '440_' || unnest(items) as listing_id
    from (select distinct request_id, steamid,
                 case when user_id % 3 = 0 then [9000000000 + user_id * 100 + k, user_id * 100 + k] else [user_id * 100 + k] end as items
          from sell_row where skip_reason is null)
)"""


_MERGED = MARKET + f""" select coalesce(s.id, r.id) as id, coalesce(r.details, s.details) as details,
    case when r.id is null then s.is_deleted else r.event = 'listing-delete' end as is_deleted,
    coalesce(s.created_at, {GENERATION_TS}) as created_at,
    case when r.id is null then s.updated_at else {GENERATION_TS} end as updated_at
    from stored s full join (
    select distinct id, event, details from reconciled) r on r.id = s.id"""


def _events(types: str) -> str:
    return MARKET + f" select {_EVENT} from reconciled join req using (request_id) where effective_type in ({types})"


def sql() -> dict[str, str]:
    """SQL per query name."""
    return {
        "parse_fanout": FEED
        + """ select ord_time, ord_partition, ord_offset, ord_pos, 'e' || event_id as event_key, event, id as listing_id,
              440 as appid, value as metal, user_id % 5 as keys, epoch_us(ts) // 1000000 as listed_at,
              case when event_id % 5 = 0 then 2 else 0 end as spells, event_id % 2 = 0 as tradable from ev""",
        "parse_rejects": FEED
        + """, broken as (select distinct msg, msg % 4 as p, msg // 4 as o, msg % 13 as how from ev),
             n as (select msg, count(*) as n from ev group by msg)
             select p as partition, o as "offset",
               case how when 1 then 'malformed_json' when 2 then 'bad_field' when 3 then 'no_data' when 4 then 'not_an_object'
                        when 5 then 'blank' when 6 then 'null_document' when 8 then 'bad_field'
                        when 9 then 'bad_envelope_field' when 10 then 'no_value' when 11 then 'malformed_json' when 12 then 'malformed_json' end as reject_reason,
               case when how in (0, 7) then n else 0 end as events
             from broken join n using (msg)""",
        "reject_previews": """
            select 'documents' as topic, doc_id as "offset", substr(text, 1, 500) as reject_preview, text as reject_value from documents
            union all select 'pages', page_id, substr(html, 1, 500), html from pages""",
        "unwritable_changes": FEED
        + """, lost as (select *, msg % 5 as how from ev where event <> 'listing-other'),
             judged as (select *, case when how = 3 then 'no_id'
                    when event = 'listing-update' and how = 2 then 'no_seller'
                    when event = 'listing-update' and how = 1 and intent = 'buy' then 'no_intent' end as defect from lost)
             select 'e' || event_id as event_key, event, defect from judged where defect is not null""",
        "json_round_trip": FEED
        + """ select 'e' || event_id as event_key, event, id as listing_id, steamid, value as metal,
              case when event_id % 4 = 0 then null else value * 2 end as raw, epoch_us(ts) // 1000000 as listed_at,
              case when k in (6, 12) then null else market end as market_name from ev""",
        "price_polymorphism": FEED
        + """ select event_id, case when event_id % 4 = 0 then value end as steam_raw,
              case when event_id % 4 = 0 then 'usd' end as currency, event_id % 4 = 0 as has_price from ev""",
        "price_list": FEED
        + """ select event_id, case event_id % 4 when 0 then 1 when 1 then 2 else 0 end as prices,
              case event_id % 4 when 0 then value when 1 then value + value * 2 end as total_raw from ev""",
        "route_updates": FEED + " select 'e' || event_id as event_key, id as listing_id from ev where event = 'listing-update'",
        "route_deletes": FEED + " select 'e' || event_id as event_key, id as listing_id from ev where event = 'listing-delete'",
        "event_counts": FEED
        + """, n as (select count(distinct msg) as m, count(*) as e, count(*) filter (event = 'listing-update') as u,
                            count(*) filter (event = 'listing-delete') as d from ev)
             select 'messages_consumed' as counter, m as value from n
             union all select 'messages_parsed_success', m from n
             union all select 'messages_parsed_failed', 0 from n
             union all select 'incoming_events', e from n
             union all select 'listing_upserts', u from n
             union all select 'deleted_listings', d from n
             union all select 'realtime_writes', u from n""",
        "write_origins": MARKET
        + """ select 'realtime' as origin, event, count(*) as writes from ev where event <> 'listing-other' group by event
              union all select 'backfill', event, count(*) from reconciled group by event""",
        "latest_state": STORED + " select id, steamid, intent, metal, details, is_deleted from stored",
        "merge_state": STORED + " select * from stored",
        "refold_state": STORED + " select id, details, is_deleted, created_at, updated_at from stored",
        "merge_reconciled": _MERGED,
        "stream_two_queries": _MERGED,
        "request_times": MARKET
        + """, took as (select effective_type, request_id, 10 * k + updates as ms from outcome join req using (request_id, effective_type)),
             ranked as (select *, row_number() over (partition by effective_type order by ms) as r,
                               count(*) over (partition by effective_type) as n from took)
             select effective_type, any_value(n) as requests, max(ms) as last_ms, min(ms) filter (r >= 0.5 * n) as median_ms,
                    min(ms) filter (r >= 0.95 * n) as p95_ms, min(ms) filter (r >= 0.99 * n) as p99_ms
             from ranked group by effective_type""",
        "union_events": MARKET
        + """ select event, count(*) as events, count(distinct id) as listings from (
                select event, id from ev union all select event, id from reconciled) group by event""",
        "listing_ids": FEED
        + """, parts as (
                select event_id, case event_id % 5 when 0 then upper(intent) when 1 then null when 2 then 'trade' else intent end as side,
                       case when event_id % 6 = 0 then ' ' else cast(event_id as varchar) end as asset,
                       case when event_id % 7 = 0 then null else steamid end as seller,
                       case when event_id % 8 = 0 then '' else market end as name from ev)
             select event_id,
               case when lower(side) = 'sell' and trim(asset) <> '' then '440_' || asset
                    when lower(side) = 'buy' and seller is not null and name <> '' then '440_' || seller || '_' || md5(name) end
                 as listing_id,
               case when side is null or lower(side) not in ('buy', 'sell') then 'unknown_intent'
                    when lower(side) = 'sell' and trim(asset) = '' then 'blank_asset'
                    when lower(side) = 'buy' and seller is null then 'blank_seller'
                    when lower(side) = 'buy' and name = '' then 'blank_market_name' end as error
             from parts""",
        "id_class": """
            with ids as (select doc_id, source || '_' || lang || case when doc_id % 3 = 0 then '_x' else '' end as id from documents)
            select doc_id, length(id) - length(replace(id, '_', '')) = 2 as is_buy,
                   length(id) - length(replace(id, '_', '')) = 1 as is_sell from ids""",
        "market_name_latest": STORED
        + """ select item_defindex, item_quality_id, arg_max(market_name, (updated_at, id)) as market_name
              from stored where market_name is not null group by all""",
        "existing_listings": STORED
        + " select item_defindex, item_quality_id, id, steamid from stored where not is_deleted",
        "listing_by_seller": STORED
        + """ select market_name, steamid, arg_max(id, (updated_at, id)) as id from stored
              where not is_deleted and market_name is not null group by all""",
        "live_listings_for_item": STORED
        + """ select item_defindex, item_quality_id, id, steamid, market_name, updated_at from stored
              where not is_deleted""",
        "listing_by_id": MARKET
        + """ select t.id, t.steamid, t.market_name, t.item_defindex, t.item_quality_id
              from stored t where not is_deleted and id in (select listing_id from single)""",
        "request_types": """
            with r as (select event_id, case event_id % 9 when 0 then 'FULL' when 1 then 'BUY_ONLY' when 2 then 'SELL_ONLY'
                              when 3 then 'SINGLE_ID' when 4 then 'FULL' when 5 then 'SINGLE_ID' end as t,
                              case event_id % 5 when 0 then '440_' || event_id when 1 then ' ' end as l,
                              event_id % 13 - 1 as d, event_id % 17 - 1 as q,
                              case when event_id % 19 = 0 then 0 when event_id % 19 = 1 then 7 end as m from events),
            ok as (select *, coalesce(t, case when trim(l) <> '' then 'SINGLE_ID' end, 'FULL') as effective_type from r
                   where event_id % 9 <> 8 and (d > 0 or d = -1) and (q > 0 or q = -1))
            select event_id as "offset", effective_type,
                   case when effective_type = 'SINGLE_ID' then case when coalesce(trim(l), '') = '' then 'listing_id' end
                        when d = -1 then 'item_defindex' when q = -1 then 'item_quality_id'
                        when effective_type = 'SELL_ONLY' and m <= 0 then 'max_inventory_size' end as refusal
            from ok""",
        "request_rejects": """
            with r as (select event_id, event_id % 9 as t, event_id % 13 - 1 as d, event_id % 17 - 1 as q from events)
            select event_id as "offset",
                   case when t = 8 then 'unknown_request_type' when d = 0 then 'item_defindex_not_positive'
                        else 'item_quality_id_not_positive' end as reject_reason
            from r where t = 8 or d = 0 or q = 0""",
        "snapshot_explode": MARKET
        + """ select market as market_name, page, pos, steamid, lower(intent) as intent, value as price, k as defindex
              from snapshot where k not in (4, 13)""",
        "snapshot_split": MARKET
        + """ select market as market_name, page, pos, steamid, lower(intent) as intent, value as price, k as defindex
              from snapshot where k not in (4, 13)""",
        "snapshot_states": MARKET
        + """ select market as market_name, case when k in (4, 13) then 'null' else 'ready' end as snapshot_state,
              count(*) filter (k not in (4, 13)) as listings from snapshot group by market, k""",
        "snapshot_buy": MARKET + " select request_id, page, pos, steamid, id as listing_id from buy_row",
        "snapshot_sell": MARKET + " select request_id, page, pos, steamid from sell_row",
        "body_clean": """
            select page_id,
                   case when x <> '' then x end as cleaned
            from (select page_id, case when strpos(html, '{') > 0 and length(html) - strpos(reverse(html), '}') + 1 > strpos(html, '{')
                       and strpos(html, '}') > 0
                       then substr(html, strpos(html, '{'), length(html) - strpos(reverse(html), '}') - strpos(html, '{') + 2)
                       else '' end as x from pages)""",
        "inventory_clean": MARKET
        + """ select steamid, case when unreadable then 'unreadable' else 'ok' end as state,
              case when not unreadable then sum(n_matches) end as n_items
              from market where intent = 'sell' group by steamid, unreadable""",
        "inventory_match": MARKET
        + """ select distinct request_id, steamid, case when unreadable then 0 else n_matches end as n_matches, skip_reason
              from sell_row""",
        "inventory_skipped": MARKET
        + " select distinct request_id, steamid, skip_reason from sell_row where skip_reason is not null",
        "buy_truth": MARKET + " select request_id, page, pos, steamid, id from reconciled where stage = 0 and request_id in (select request_id from judged where wants_buy)",
        "sell_truth": MARKET
        + """ select h.request_id, h.page, h.pos, h.steamid, h.user_id * 100 + h.k as item_id, h.id
              from sell_hit h join judged j using (request_id)
              where j.sell_runs and (j.sell_until is null or (h.page, h.pos) < j.sell_until)""",
        "truth_profiles": MARKET
        + """ select b.request_id, b.page, b.pos, case when b.event_id % 2 = 0 then 'BUY' else 'buy' end as intent, b.steamid,
                b.k as defindex, b.quality, cast(null as bigint) as item_id,
                case when not b.gone and not b.no_id then b.id end as actual_id, false as is_complete,
                not b.gone and not b.no_id as has_minimum,
                'Missing: Inventory item' || case when b.gone then ', Listing detail' else '' end as missing
              from buy_row b
              union all
              select h.request_id, h.page, h.pos, case when h.event_id % 2 = 0 then 'SELL' else 'sell' end, h.steamid,
                h.k, h.quality, h.user_id * 100 + h.k, h.id, true, true, 'Complete'
              from sell_hit h join judged j using (request_id)
              where j.sell_runs and (j.sell_until is null or (h.page, h.pos) < j.sell_until)""",
        "stale_buy": MARKET + " select request_id, id, steamid from stale_buy",
        "stale_sell": MARKET + " select request_id, id, steamid from stale_sell",
        "single_id": _events("'SINGLE_ID'"),
        "buy_only": _events("'BUY_ONLY'"),
        "sell_only": _events("'SELL_ONLY'"),
        "full_backfill": _events("'FULL'"),
        "reconcile_all": MARKET + f" select {_EVENT} from reconciled",
        "reconcile_shared": MARKET
        + f""" select request_id || '-' || n as request_id, stage, page, pos, id, event, {GENERATION_TS} + n as generation_timestamp,
                      steamid, details from reconciled, range(3) copies(n)""",
        "request_outcomes": MARKET + " select * from outcome",
        "request_counters": MARKET
        + """ select 'requests_consumed' as counter, count(*) as value from outcome
              union all select 'requests_processed', count(*) from outcome where status = 'processed'
              union all select 'requests_failed', count(*) from outcome where status = 'failed'
              union all select 'requests_pending', 0""",
        "handler_metrics": MARKET
        + """ select effective_type, counter, count(*) as value from (
                select request_id, 'requests' as counter from req
                union all select request_id, 'inventory_scans' from (select distinct request_id, steamid from sell_row)
                union all select request_id, 'sellers_filtered' from (
                    select distinct request_id, steamid from sell_row where skip_reason = 'inventory_size')
                union all select request_id, 'ids_generated' from buy_row
                union all select request_id, case event when 'listing-delete' then 'stale_detected' else 'listings_updated' end
                    from reconciled) join req using (request_id) group by all""",
        "fetch_outcomes": MARKET
        + """ select 'detail' as endpoint, case when gone then 'missing' else 'ok' end as outcome, count(*) as responses
              from market group by gone
              union all select 'inventory', 'ok', count(distinct steamid) from market where intent = 'sell'
              union all select 'snapshot', 'ok', count(distinct (market, page)) from market""",
        "fetch_worklist": MARKET
        + """, open as (select distinct endpoint, key from need
                        where (endpoint = 'detail' and key not in (select id from market)) or (endpoint = 'inventory' and key in (select steamid from market where unreadable))),
             slots as (select *, row_number() over (partition by endpoint order by md5(key), key) - 1 as slot from open)
             select endpoint, key, replace(url_encode(key), '%20', '+') as encoded_key, slot,
                    slot * case endpoint when 'detail' then 1 else 10 end as start_second from slots""",
        "landed_states": MARKET
        + """ select distinct 'snapshot' as endpoint, market as key, page, case when k in (4, 13) then 'null' else 'ok' end as state from market
              union all
              select distinct 'inventory', steamid, 0, case when unreadable then 'unreadable' else 'ok' end from market where intent = 'sell'
              union all
              select 'detail', id, 0, case when gone then 'missing' else 'ok' end from market""",
        "fetch_frontier": MARKET
        + _TRIES
        + """, seen as (select id, gone from market where ascii(right(id, 1)) % 3 <> 0),
             search as (select request_id, steamid, min(pos) filter (not s.gone) as hit, min(pos) filter (s.id is null) as open,
                               arg_min(listing_id, pos) filter (s.id is null) as key
                        from tries t left join seen s on s.id = t.listing_id group by all)
             select request_id, 'detail' as endpoint, key from search where open is not null and (hit is null or open < hit)
             union
             select n.request_id, n.endpoint, n.key from need n
             where (n.endpoint = 'inventory' and n.key in (select steamid from market where unreadable))
                or (n.endpoint = 'detail' and n.key not in (select id from seen)
                    and exists (from candidate c where c.request_id = n.request_id and c.listing_id = n.key and c.part <> 'sell'))""",
        "frontier_calls": MARKET
        + _TRIES
        + """, hits as (select t.request_id, t.steamid, min(t.pos) as hit from tries t join market m on m.id = t.listing_id where not m.gone group by all),
             calls as (
               select t.request_id, 'detail' as endpoint, t.listing_id as key
               from tries t left join hits h using (request_id, steamid) where h.hit is null or t.pos <= h.hit
               union
               select n.request_id, n.endpoint, n.key from need n
               where n.endpoint <> 'detail'
                  or exists (from candidate c where c.request_id = n.request_id and c.listing_id = n.key and c.part <> 'sell'))
             select request_id, endpoint, count(*) as calls from calls group by all""",
        "fetch_budget": MARKET + " select request_id, endpoint, count(distinct key) as calls from need group by all",
        "landed_latest": MARKET + " select id as listing_id, case when gone then 'missing' else 'ok' end as state from market",
        "request_freshness": MARKET
        + """ select c.request_id, c.part, c.listing_id, m.id is not null and ascii(right(c.listing_id, 1)) % 2 = 0 as landed
              from candidate c left join market m on m.id = c.listing_id""",
        "report_by_chosen_items": STORED
        + """ select item_defindex, item_quality_id, count(*) as total_listings, count(*) filter (intent = 'buy') as buy_listings,
              count(*) filter (intent = 'sell') as sell_listings, max(updated_at) as last_update from stored
              where item_defindex in (3, 5, 12) group by all""",
        "url_values": """
            select 'page' as kind, page_id as id, replace(replace(replace(url_encode(url), '%20', '+'), '%2A', '*'), '~', '%7E') as encoded
            from pages
            union all
            select 'part', p_partkey, replace(replace(replace(url_encode(p_name), '%20', '+'), '%2A', '*'), '~', '%7E') from part""",
        "report_activity": STORED
        + """, t as (select max(updated_at) + 60000 as now from stored)
             select count(*) as total_listings,
                    count(*) filter (updated_at > now - 3600000) as last_hour_updates,
                    count(*) filter (created_at > now - 3600000) as last_hour_new,
                    count(*) filter (updated_at > now - 300000) as last_minutes_updates,
                    count(*) filter (updated_at > now - 86400000) as last_day_updates
             from stored, t""",
        "report_by_item": STORED
        + """ select item_defindex, item_quality_id, count(*) as total_listings, count(*) filter (intent = 'buy') as buy_listings,
              count(*) filter (intent = 'sell') as sell_listings, max(updated_at) as last_update from stored group by all""",
        "report_by_item_incremental": STORED
        + """ select item_defindex, item_quality_id, count(*) as total_listings, count(*) filter (intent = 'buy') as buy_listings,
              count(*) filter (intent = 'sell') as sell_listings, max(updated_at) as last_update from stored group by all""",
        "price_ladder": STORED
        + """ select id, intent, raw_value, short_value from stored where item_defindex = 5 and item_quality_id = 6""",
        "browse": STORED + " select id, steamid, market_name, raw_value from stored order by id limit 10",
        "time_helpers": """
            select event_id,
                   case when (epoch_us(ts) // 1000) % 1000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
                        else rtrim(strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%dT%H:%M:%S.%g'), '0') end as iso,
                   (epoch_us(ts) // 1000) as back, epoch_us(ts) // 1000000 * 1000 - 3600000 as zoned,
                   (epoch_us(ts) // 1000) - 5 * 60000 as minutes_ago, (epoch_us(ts) // 1000) - 2 * 3600000 as hours_ago,
                   (epoch_us(ts) // 1000) - 3 * 86400000 as days_ago
            from events""",
        "stream_state": STORED + " select id, details, is_deleted, created_at, updated_at from stored",
    }
