"""The same results as independent SQL, for another engine to check ours against.

Written from the rules, not from our plans: survivors and favourites by row_number, distinct counts directly, means
by integer division. Each statement is self-contained over the star-schema tables.
"""

from __future__ import annotations

_RAW = """
once as (
  select
    (7 * l_orderkey + l_linenumber) % 100 = 42 as twice,
    'TXN-' || l_orderkey || '-' || l_linenumber as transaction_id,
    case when l_orderkey % 50 = 7 then null
         else 'CUST-' || lpad(cast(o_custkey as varchar), cast(greatest(6, length(cast(o_custkey as varchar))) as integer), '0')
    end as customer_id,
    'MERCH-' || lpad(cast(l_suppkey as varchar), cast(greatest(4, length(cast(l_suppkey as varchar))) as integer), '0')
      as merchant_id,
    s_name as merchant_name,
    case when l_partkey % 50 = 3 then null
         else case l_suppkey % 9 when 0 then 'Groceries' when 1 then 'Transport' when 2 then 'Dining'
              when 3 then 'Entertainment' when 4 then 'Healthcare' when 5 then 'Utilities'
              when 6 then 'Retail' when 7 then 'Travel' else 'ATM Withdrawal' end end as merchant_category,
    cast((case when (l_orderkey + l_linenumber) % 200 = 5 then -1 else 1 end)
       * round(cast(case when l_quantity > 50 - l_suppkey % 5 then cast(l_extendedprice as decimal(18,2)) * 0.50
              else cast(l_extendedprice as decimal(18,2)) * 0.01 end as decimal(18,4)), 2) as double) as amount,
    case when l_partkey % 50 = 9 then null when l_partkey % 50 = 10 then 'XXX'
         when l_partkey % 3 = 0 then 'GBP' when l_partkey % 3 = 1 then 'USD' else 'EUR' end as currency,
    case when l_partkey % 50 = 11 then null when l_partkey % 50 = 12 then 'INVALID'
         when l_linenumber % 4 = 0 then 'online' when l_linenumber % 4 = 1 then 'in-store'
         when l_linenumber % 4 = 2 then 'mobile' else 'ATM' end as channel,
    case when l_partkey % 50 = 13 then 'INVALID' when o_orderstatus = 'O' then 'pending'
         when o_orderstatus = 'P' then 'failed' when l_returnflag = 'R' then 'reversed'
         else 'completed' end as status,
    strftime(l_shipdate, '%Y-%m-%d') as transaction_date,
    case when l_partkey % 100 = 21 then null when l_partkey % 100 = 22 then 'n/a'
         else lpad(cast(l_partkey % 24 as varchar), 2, '0') || ':' || lpad(cast(l_orderkey % 60 as varchar), 2, '0')
              || ':' || lpad(cast(l_suppkey % 60 as varchar), 2, '0') end as transaction_time,
    case when l_partkey % 50 = 14 then null else n_name end as customer_location,
    abs(case when l_quantity > 50 - l_suppkey % 5 then l_extendedprice * 0.5 else l_extendedprice * 0.01 end) > 5000
      as is_flagged
  from lineitem
  join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join supplier on l_suppkey = s_suppkey
),
raw as (select * exclude (twice) from once union all select * exclude (twice) from once where twice)"""

_COLUMNS = (
    "transaction_id, customer_id, merchant_id, merchant_name, merchant_category, amount, currency, channel, status, "
    "transaction_date, transaction_time, customer_location, is_flagged"
)

_DEDUP = f"""
numbered as (
  select *, row_number() over (partition by transaction_id order by
    transaction_date nulls first, transaction_time nulls first, merchant_id nulls first, merchant_name nulls first,
    customer_id nulls first, merchant_category nulls first, amount nulls first, currency nulls first,
    channel nulls first, status nulls first, customer_location nulls first, is_flagged nulls first) as copy
  from raw
),
dedup as (select {_COLUMNS} from numbered where copy = 1)"""

_REQUIRED = """
required as (
  select * from dedup
  where transaction_id is not null and customer_id is not null and merchant_id is not null
    and amount is not null and transaction_date is not null
)"""

_POSITIVE = """
positive as (select * from required where amount > 0 and isfinite(amount))"""

_STANDARD = """
standard as (
  select * replace (
    case when currency in ('GBP', 'USD', 'EUR') then currency else 'unknown' end as currency,
    case when channel in ('online', 'in-store', 'mobile', 'ATM') then channel else 'unknown' end as channel,
    case when status in ('completed', 'pending', 'failed', 'reversed') then status else 'unknown' end as status)
  from positive
)"""

_TIMED = """
timed as (
  select *, strftime(transaction_timestamp, '%Y-%m') as transaction_month,
    cast(dayofweek(transaction_timestamp) + 1 as integer) as day_of_week
  from (select *, try_strptime(concat_ws(' ', transaction_date, transaction_time), '%Y-%m-%d %H:%M:%S')
          as transaction_timestamp from standard)
)"""

_SILVER = """
silver as (select * from timed where transaction_timestamp is not null)"""


def _total(amount: str) -> str:
    return f"cast(round(sum(cast({amount} as decimal(38,10))), 2) as double)"


def _mean(amount: str) -> str:
    micros = f"sum(cast(cast({amount} as decimal(22,6)) * 1000000 as hugeint))"
    rows = f"count({amount})"
    return f"cast((2 * {micros} + {rows} * 10000) // (2 * {rows} * 10000) as bigint) / 100.0"


def _count_if(condition: str) -> str:
    return f"cast(count(*) filter (where {condition}) as bigint)"


_CUSTOMER_CORE = f"""
customer_core as (
  select customer_id,
    count(transaction_id) as total_transactions,
    {_total('amount')} as total_spend,
    {_mean('amount')} as avg_transaction_value,
    round(max(amount), 2) as max_transaction_value,
    round(min(amount), 2) as min_transaction_value,
    count(distinct merchant_id) as unique_merchants_used,
    count(distinct transaction_month) as active_months,
    {_count_if('is_flagged')} as flagged_transaction_count,
    {_count_if("status = 'completed'")} as completed_transactions,
    {_count_if("status = 'failed'")} as failed_transactions,
    max(transaction_timestamp) as last_transaction_date,
    min(transaction_timestamp) as first_transaction_date
  from silver group by customer_id
)"""


def _favourite(name: str, column: str) -> str:
    return f"""
{name} as (
  select customer_id, {column} as {name} from (
    select customer_id, {column}, row_number() over (
      partition by customer_id order by count(*) desc, {column} asc nulls last) as place
    from silver group by customer_id, {column})
  where place = 1
)"""


_FAVOURITES = _favourite("preferred_channel", "channel") + "," + _favourite("preferred_category", "merchant_category")

_CUSTOMERS = """
customers as (
  select c.*, preferred_channel, preferred_category,
    round(flagged_transaction_count / total_transactions * 100, 2) as fraud_risk_score,
    case when total_spend >= 50000 then 'Premium' when total_spend >= 20000 then 'High Value'
         when total_spend >= 5000 then 'Mid Tier' else 'Standard' end as customer_segment
  from customer_core c
  left join preferred_channel using (customer_id)
  left join preferred_category using (customer_id)
)"""

_MERCHANT_CORE = f"""
merchant_core as (
  select merchant_id, merchant_name, merchant_category,
    count(transaction_id) as total_transactions,
    {_total('amount')} as total_revenue,
    {_mean('amount')} as avg_transaction_value,
    count(distinct customer_id) as unique_customers,
    {_count_if('is_flagged')} as flagged_transactions,
    {_count_if("status = 'completed'")} as completed_transactions,
    {_count_if("currency = 'GBP'")} as gbp_transactions,
    {_count_if("channel = 'online'")} as online_transactions
  from silver where merchant_category is not null
  group by merchant_id, merchant_name, merchant_category
)"""

_MERCHANTS = """
merchants as (
  select *,
    cast(rank() over (partition by merchant_category order by total_revenue desc) as integer) as rank_in_category,
    case when flagged_transactions / total_transactions > 0.05 then 'High Risk'
         when flagged_transactions / total_transactions > 0.02 then 'Medium Risk'
         else 'Low Risk' end as merchant_risk_flag
  from merchant_core
)"""

_MONTHLY_CORE = f"""
monthly_core as (
  select transaction_month,
    count(transaction_id) as total_transactions,
    {_total('amount')} as total_volume,
    {_mean('amount')} as avg_transaction_value,
    count(distinct customer_id) as active_customers,
    count(distinct merchant_id) as active_merchants,
    {_count_if('is_flagged')} as flagged_transactions,
    {_count_if("status = 'failed'")} as failed_transactions
  from silver group by transaction_month
)"""

_MONTHS = """
months as (
  select transaction_month, total_transactions, total_volume, avg_transaction_value, active_customers,
    active_merchants, flagged_transactions, failed_transactions, prev_month_volume,
    round((total_volume - prev_month_volume) / nullif(prev_month_volume, 0) * 100, 2) as mom_volume_growth_pct,
    prev_month_transactions,
    round((total_transactions - prev_month_transactions) / nullif(prev_month_transactions, 0) * 100, 2)
      as mom_transaction_growth_pct,
    cast(round(sum(cast(total_volume as decimal(38,10))) over (
      order by transaction_month rows between unbounded preceding and current row), 2) as double)
      as running_total_volume
  from (select *, lag(total_volume) over (order by transaction_month) as prev_month_volume,
          lag(total_transactions) over (order by transaction_month) as prev_month_transactions
        from monthly_core)
)"""

_HOURS = f"""
hours as (
  select date_trunc('hour', transaction_timestamp) as period, count(*) as total_transactions,
    {_total('amount')} as total_volume, {_count_if('is_flagged')} as flagged_transactions
  from silver group by 1
)"""

_TO_DEDUP = (_RAW, _DEDUP)
_TO_SILVER = (_RAW, _DEDUP, _REQUIRED, _POSITIVE, _STANDARD, _TIMED, _SILVER)
_TO_CUSTOMERS = (_CUSTOMER_CORE, _FAVOURITES, _CUSTOMERS)
_TO_MERCHANTS = (_MERCHANT_CORE, _MERCHANTS)
_TO_MONTHS = (_MONTHLY_CORE, _MONTHS)
_TO_GOLD = (*_TO_SILVER, *_TO_CUSTOMERS, *_TO_MERCHANTS, *_TO_MONTHS)


def _with(ctes: tuple[str, ...], select: str) -> str:
    return "with" + ",".join(ctes) + "\n" + select


def _after(last: str, select: str) -> str:
    """The chain up to and including the CTE called ``last``."""
    steps = ("raw", "dedup", "required", "positive", "standard", "timed", "silver")
    return _with(_TO_SILVER[: steps.index(last) + 1], select)


def _from_silver(ctes: tuple[str, ...], select: str) -> str:
    return _with((*_TO_SILVER, *ctes), select)


def _no_violations(checks: dict[str, str]) -> str:
    """One row per check; each value is a scalar query that counts violations."""
    rows = " union all ".join(
        f"select '{name}' as check_name, cast(0 as double) as expected, cast(({count}) as double) as actual"
        for name, count in checks.items()
    )
    return f"select *, expected = actual as passed from ({rows})"


def _equalities(checks: dict[str, tuple[str, str]]) -> str:
    rows = " union all ".join(
        f"select '{name}' as check_name, cast(({expected}) as double) as expected, cast(({actual}) as double) as actual"
        for name, (expected, actual) in checks.items()
    )
    return f"select *, expected = actual as passed from ({rows})"


def _count(table: str, where: str) -> str:
    return f"select count(*) from {table} where {where}"


def _repeats(table: str, key: str) -> str:
    return f"select coalesce(sum(n - 1), 0) from (select count(*) as n from {table} group by {key})"


def _missing(upper: str, lower: str, key: str) -> str:
    return (
        f"select count(*) from (select distinct {key} from {upper}) u "
        f"where not exists (select 1 from {lower} l where l.{key} = u.{key})"
    )


def _last_running_total() -> tuple[str, str]:
    return (
        f"select {_total('total_volume')} from months",
        "select running_total_volume from months order by transaction_month desc limit 1",
    )


_SOURCE = "'landing/transactions.csv'"
_SILVER_COLUMNS = (
    f"{_COLUMNS}, {_SOURCE} as source_file, 'silver' as pipeline_layer, transaction_timestamp, transaction_month, "
    "day_of_week"
)
_REASONS = """
select 'duplicate' as reason, (select count(*) from raw) - (select count(*) from dedup) as rows
union all select 'critical_null', (select count(*) from dedup) - (select count(*) from required)
union all select 'invalid_amount', (select count(*) from required) - (select count(*) from positive)
union all select 'bad_timestamp', (select count(*) from timed) - (select count(*) from silver)
union all select 'kept', (select count(*) from silver)"""

_RAW_NULLS = " + ".join(f"count(*) filter (where {c.strip()} is null)" for c in _COLUMNS.split(","))


def oracle_sql() -> dict[str, str]:
    raw = _after("raw", f"select {_COLUMNS} from raw")
    bronze = _after("raw", f"select {_COLUMNS}, {_SOURCE} as source_file, 'bronze' as pipeline_layer from raw")
    silver = _after("silver", f"select {_SILVER_COLUMNS} from silver")
    trends = _from_silver(_TO_MONTHS, "select * from months")
    figures = _with(
        _TO_GOLD,
        f"""select *, '£' || format('{{:,.2f}}', total_volume) as total_volume_display from (select
        (select count(*) from customers) as customers,
        (select count(*) from merchants) as merchants,
        (select count(*) from months) as months,
        ({_count('merchants', "merchant_risk_flag = 'High Risk'")}) as high_risk_merchants,
        ({_count('customers', "customer_segment = 'Premium'")}) as premium_customers,
        (select {_total('total_volume')} from months) as total_volume)""",
    )
    return {
        "raw_fixture": raw,
        "raw_profile": _after(
            "raw",
            f"""select count(*) as total_records, cast({_RAW_NULLS} as bigint) as null_values,
            count(*) - (select count(*) from (select distinct * from raw)) as duplicate_rows,
            {_count_if('is_flagged')} as flagged_transactions from raw""",
        ),
        "bronze_csv_scan": raw,
        "bronze_metadata": _after(
            "raw",
            f"select {_COLUMNS}, {_SOURCE} as source_file, 'bronze' as pipeline_layer, "
            "true as has_ingestion_timestamp from raw",
        ),
        "bronze_roundtrip": bronze,
        "silver_dedup": _after("dedup", f"select {_COLUMNS} from dedup"),
        "silver_drop_nulls": _after("required", f"select {_COLUMNS} from required"),
        "silver_valid_amounts": _after("positive", f"select {_COLUMNS} from positive"),
        "silver_categoricals": _after("standard", "select transaction_id, currency, channel, status from standard"),
        "silver_timestamps": _after(
            "silver", "select transaction_id, transaction_timestamp, transaction_month, day_of_week from silver"
        ),
        "silver_metadata": silver,
        "silver": silver,
        "silver_roundtrip": silver,
        "silver_month_pruned_scan": _after(
            "silver", f"select {_SILVER_COLUMNS} from silver where transaction_month = '1998-06'"
        ),
        "silver_quality_report": _after("silver", _REASONS),
        "silver_domains": _after(
            "silver",
            """select 'currency' as "column", currency as value, count(*) as rows from silver group by currency
            union all select 'channel', channel, count(*) from silver group by channel
            union all select 'status', status, count(*) from silver group by status""",
        ),
        "customer_core": _from_silver((_CUSTOMER_CORE,), "select * from customer_core"),
        "customer_channel_counts": _from_silver(
            (), "select customer_id, channel, count(*) as n from silver group by customer_id, channel"
        ),
        "customer_category_counts": _from_silver(
            (),
            "select customer_id, merchant_category, count(*) as n from silver group by customer_id, merchant_category",
        ),
        "customer_preferred_channel": _from_silver((_FAVOURITES,), "select * from preferred_channel"),
        "customer_preferred_category": _from_silver((_FAVOURITES,), "select * from preferred_category"),
        "customer_fraud_score": _from_silver(_TO_CUSTOMERS, "select customer_id, fraud_risk_score from customers"),
        "customer_segment": _from_silver(_TO_CUSTOMERS, "select customer_id, customer_segment from customers"),
        "customer_summary": _from_silver(_TO_CUSTOMERS, "select * from customers"),
        "merchant_core": _from_silver((_MERCHANT_CORE,), "select * from merchant_core"),
        "merchant_rank": _from_silver(
            _TO_MERCHANTS, "select merchant_id, merchant_name, merchant_category, rank_in_category from merchants"
        ),
        "merchant_risk": _from_silver(
            _TO_MERCHANTS, "select merchant_id, merchant_name, merchant_category, merchant_risk_flag from merchants"
        ),
        "merchant_analytics": _from_silver(_TO_MERCHANTS, "select * from merchants"),
        "monthly_core": _from_silver((_MONTHLY_CORE,), "select * from monthly_core"),
        "monthly_mom_growth": _from_silver(
            _TO_MONTHS,
            "select transaction_month, prev_month_volume, mom_volume_growth_pct, prev_month_transactions, "
            "mom_transaction_growth_pct from months",
        ),
        "monthly_running_total": _from_silver(_TO_MONTHS, "select transaction_month, running_total_volume from months"),
        "monthly_trends": trends,
        "gold_roundtrip": trends,
        "gold_customers_roundtrip": _from_silver(_TO_CUSTOMERS, "select * from customers"),
        "gold_merchants_roundtrip": _from_silver(_TO_MERCHANTS, "select * from merchants"),
        "pipeline_summary": figures,
        "kpi_summary": figures,
        "sample_customers": _from_silver(
            _TO_CUSTOMERS,
            "select customer_id, total_transactions, total_spend, customer_segment, fraud_risk_score, "
            "preferred_channel, preferred_category from customers order by customer_id limit 5",
        ),
        "sample_merchants": _from_silver(
            _TO_MERCHANTS,
            "select merchant_name, merchant_category, total_transactions, total_revenue, unique_customers, "
            "merchant_risk_flag, rank_in_category from merchants "
            "order by merchant_id, merchants.merchant_name, merchants.merchant_category limit 5",
        ),
        "sample_months": _from_silver(
            _TO_MONTHS,
            "select transaction_month, total_transactions, total_volume, active_customers, mom_volume_growth_pct, "
            "running_total_volume from months order by transaction_month limit 12",
        ),
        "dq_key_uniqueness": _with(
            _TO_GOLD,
            _no_violations(
                {
                    "silver_transaction_id": _repeats("silver", "transaction_id"),
                    "customer_summary_customer_id": _repeats("customers", "customer_id"),
                    "merchant_analytics_key": _repeats("merchants", "merchant_id, merchant_name, merchant_category"),
                    "monthly_trends_month": _repeats("months", "transaction_month"),
                }
            ),
        ),
        "dq_null_counts": _with(
            _TO_GOLD,
            _no_violations(
                {"bronze_ingestion_timestamp_null": "select 0"}
                | {
                    f"silver_{c}_null": _count("silver", f"{c} is null")
                    for c in (
                        "transaction_id",
                        "customer_id",
                        "merchant_id",
                        "amount",
                        "transaction_date",
                        "transaction_timestamp",
                        "transaction_month",
                    )
                }
                | {"merchant_analytics_merchant_category_null": _count("merchants", "merchant_category is null")}
            ),
        ),
        "dq_domains": _with(
            _TO_GOLD,
            _no_violations(
                {
                    "bronze_pipeline_layer_outside": "select 0",
                    "silver_currency_outside": _count("silver", "currency not in ('GBP', 'USD', 'EUR', 'unknown')"),
                    "silver_channel_outside": _count(
                        "silver", "channel not in ('online', 'in-store', 'mobile', 'ATM', 'unknown')"
                    ),
                    "silver_status_outside": _count(
                        "silver", "status not in ('completed', 'pending', 'failed', 'reversed', 'unknown')"
                    ),
                    "silver_pipeline_layer_outside": "select 0",
                    "customer_summary_customer_segment_outside": _count(
                        "customers", "customer_segment not in ('Premium', 'High Value', 'Mid Tier', 'Standard')"
                    ),
                    "merchant_analytics_merchant_risk_flag_outside": _count(
                        "merchants", "merchant_risk_flag not in ('High Risk', 'Medium Risk', 'Low Risk')"
                    ),
                }
            ),
        ),
        "dq_ranges": _with(
            _TO_GOLD,
            _no_violations(
                {
                    "silver_amount_not_positive": _count("silver", "amount <= 0"),
                    "fraud_risk_score_outside_0_100": _count(
                        "customers", "fraud_risk_score < 0 or fraud_risk_score > 100"
                    ),
                    "category_without_rank_1": "select count(*) from (select min(rank_in_category) as best "
                    "from merchants group by merchant_category) where best <> 1",
                }
            ),
        ),
        "dq_business_rules": _with(
            _TO_GOLD,
            _no_violations(
                {
                    "premium_below_floor": _count("customers", "customer_segment = 'Premium' and total_spend < 50000"),
                    "high_risk_at_or_below_floor": _count(
                        "merchants",
                        "merchant_risk_flag = 'High Risk' and flagged_transactions / total_transactions <= 0.05",
                    ),
                }
            ),
        ),
        "dq_running_total": _from_silver(
            _TO_MONTHS,
            _equalities(
                {
                    "running_total_falls": (
                        "select 0",
                        "select count(*) from (select running_total_volume < lag(running_total_volume) over "
                        "(order by transaction_month) as fell from months) where fell",
                    ),
                    "final_running_total": _last_running_total(),
                }
            ),
        ),
        "dq_first_month": _from_silver(
            _TO_MONTHS,
            _no_violations(
                {
                    "first_month_with_growth": _count(
                        "months",
                        "transaction_month = (select min(transaction_month) from months) and "
                        "(mom_volume_growth_pct is not null or mom_transaction_growth_pct is not null)",
                    ),
                    "month_without_its_predecessor": "select count(*) from (select prev_month_volume, "
                    "lag(total_volume) over (order by transaction_month) as before, "
                    "row_number() over (order by transaction_month) as position from months) "
                    "where position > 1 and prev_month_volume is distinct from before",
                }
            ),
        ),
        "recon_orphans": _with(
            _TO_GOLD,
            _no_violations(
                {
                    "silver_transactions_not_in_bronze": _missing("silver", "raw", "transaction_id"),
                    "customers_not_in_silver": _missing("customers", "silver", "customer_id"),
                    "merchants_not_in_silver": _missing("merchants", "silver", "merchant_id"),
                    "months_not_in_silver": _missing("months", "silver", "transaction_month"),
                }
            ),
        ),
        "clustered_customers": _from_silver(_TO_CUSTOMERS, "select * from customers"),
        "clustered_merchants": _from_silver(_TO_MERCHANTS, "select * from merchant_core"),
        "hourly_trends": _with(
            (*_TO_SILVER, _HOURS),
            f"""select period, total_transactions, total_volume, flagged_transactions, prev_volume,
            round((total_volume - prev_volume) / nullif(prev_volume, 0) * 100, 2) as volume_growth_pct, prev_transactions,
            round((total_transactions - prev_transactions) / nullif(prev_transactions, 0) * 100, 2) as transaction_growth_pct,
            cast(round(sum(cast(total_volume as decimal(38,10))) over (order by period rows unbounded preceding), 2) as double)
              as running_total_volume
            from (select *, lag(total_volume) over (order by period) as prev_volume,
              lag(total_transactions) over (order by period) as prev_transactions from hours)""",
        ),
        "bronze_rejects": _after(
            "raw",
            """select transaction_id, reason, count(*) as rows from (
              select transaction_id, case (cast(split_part(transaction_id, '-', 2) as bigint) + 3 * cast(split_part(transaction_id, '-', 3) as bigint)) % 40
                when 1 then 'too few fields' when 2 then 'too many fields'
                when 3 then 'unreadable amount' when 4 then 'unreadable flag' end as reason
              from raw) where reason is not null group by transaction_id, reason""",
        ),
        "merged_silver": _after("silver", f"select * exclude (source_file) from (select {_SILVER_COLUMNS} from silver)"),
        "merged_customers": _from_silver(_TO_CUSTOMERS, "select * from customers"),
        "merged_merchants": _from_silver(_TO_MERCHANTS, "select * from merchants"),
        "merged_months": trends,
        "recon_totals": _with(
            _TO_GOLD,
            _equalities(
                {
                    "volume_in_months": (
                        f"select {_total('amount')} from silver",
                        f"select {_total('total_volume')} from months",
                    ),
                    "volume_in_customers": (
                        f"select {_total('amount')} from silver",
                        f"select {_total('total_spend')} from customers",
                    ),
                    "transactions_in_months": (
                        "select count(*) from silver",
                        "select sum(total_transactions) from months",
                    ),
                    "flagged_in_customers": (
                        _count("silver", "is_flagged"),
                        "select sum(flagged_transaction_count) from customers",
                    ),
                    "completed_in_customers": (
                        _count("silver", "status = 'completed'"),
                        "select sum(completed_transactions) from customers",
                    ),
                    "final_running_total": _last_running_total(),
                }
            ),
        ),
        "recon_row_accounting": _after(
            "silver",
            _equalities(
                {
                    "bronze_rows_explained": (
                        "select count(*) from raw",
                        f"select sum(rows) from ({_REASONS})",
                    ),
                    "rows_kept": (
                        "select count(*) from silver",
                        f"select rows from ({_REASONS}) where reason = 'kept'",
                    ),
                }
            ),
        ),
    }
