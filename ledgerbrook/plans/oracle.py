"""The registered queries once more as SQL, written against the definitions of the
operators and independent of how Spark computes them."""

from __future__ import annotations

_VIEWS = {
    "branches": """
select printf('BRN-%04d', n_nationkey) branch_id,
       concat(' ', n_name, ' Main Branch ') branch_name, n_name city, r_name state,
       case n_nationkey % 5 when 0 then 'Urban' when 1 then 'Semi-Urban' when 2 then 'Rural'
            when 3 then 'Metro' else 'Corporate' end branch_type
from nation join region on n_regionkey = r_regionkey""",
    "merchants": """
select printf('MER-%05d', s_suppkey) merchant_id,
       concat(' ', s_name, ' ') merchant_name,
       case s_suppkey % 10 when 0 then 'Grocery' when 1 then 'Travel' when 2 then 'Restaurant'
            when 3 then 'Electronics' when 4 then 'Healthcare' when 5 then 'Education'
            when 6 then 'Entertainment' when 7 then 'Fuel' when 8 then 'Shopping'
            else 'Utilities' end merchant_category, n_name city
from supplier join nation on s_nationkey = n_nationkey""",
    "customers": """
select case when c_custkey % 101 = 100 then null
            else printf('CUST-%07d', c_custkey) end customer_id,
       case when c_custkey % 89 = 88 then null else concat(' ', c_name, ' ') end name,
       cast(case when c_custkey % 53 = 52 then 5 + c_custkey % 13 else 18 + c_custkey % 63 end as varchar) age,
       case c_custkey % 3 when 0 then 'Male' when 1 then 'Female' else 'Other' end gender,
       n_name city, r_name state,
       cast(cast(c_acctbal * 30 as decimal(15,2)) as varchar) income,
       cast(date '2015-01-01' + cast(c_custkey % 3400 as int) as varchar) account_open_date,
       case c_mktsegment when 'BUILDING' then 'Regular' when 'AUTOMOBILE' then 'Premium'
            when 'FURNITURE' then 'High Net Worth' when 'HOUSEHOLD' then 'Student'
            else 'Senior' end customer_segment
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "accounts": """
select printf('ACC-%07d', c_custkey) account_id,
       printf('CUST-%07d', c_custkey) customer_id,
       case c_custkey % 3 when 0 then 'Savings' when 1 then 'Current' else 'Salary' end account_type,
       printf('BRN-%04d', c_nationkey) branch_id,
       cast(cast(c_acctbal as decimal(15,2)) as varchar) balance,
       case when c_custkey % 67 = 66 then 'UNKNOWN' when c_custkey % 20 = 0 then ' BLOCKED '
            when c_custkey % 20 = 1 then 'CLOSED' else 'ACTIVE' end account_status
from customer""",
    "tx_bulk": """
select case when l_orderkey % 211 = 210 then null
            else concat(cast(l_orderkey as varchar), '-', cast(l_linenumber as varchar)) end transaction_id,
       case when l_orderkey % 97 = 96 then 'ACC-INVALID-999999'
            else printf('ACC-%07d', o_custkey) end account_id,
       case l_linenumber % 8 when 0 then 'UPI' when 1 then 'CARD' when 2 then 'ATM' when 3 then 'NEFT'
            when 4 then 'IMPS' when 5 then 'RTGS' when 6 then 'CASH_DEPOSIT'
            else 'CASH_WITHDRAWAL' end transaction_type,
       cast(cast(case when l_orderkey % 83 = 82 then -l_extendedprice else l_extendedprice end
            as decimal(15,2)) as varchar) amount,
       cast(cast(l_shipdate as date) as varchar) ts_text,
       printf('MER-%05d', l_suppkey) merchant_id,
       concat('CITY-', cast(l_partkey % 50 as varchar)) "location",
       case l_returnflag when 'R' then 'Card' when 'A' then 'Wallet' else 'Transfer' end payment_method,
       case o_orderstatus when 'F' then 'FAILED' when 'P' then 'PENDING' else 'SUCCESS' end status,
       case substring(o_orderpriority, 1, 1) when '1' then 'Mobile' when '2' then 'Internet Banking'
            when '3' then 'ATM' when '4' then 'Branch' else 'Online' end channel,
       l_shipdate ingestion_timestamp
from lineitem join orders on l_orderkey = o_orderkey""",
    "tx": """
select transaction_id, account_id, transaction_type, try_cast(amount as decimal(15,2)) amount,
       merchant_id, "location", payment_method, status, channel, ingestion_timestamp,
       try_cast(ts_text as timestamp) transaction_timestamp
from tx_bulk""",
    "tx_events": """
select printf('TXN-%010d', event_id) transaction_id,
       printf('ACC-%07d', user_id) account_id,
       cast(value as decimal(15,2)) amount, ts transaction_timestamp,
       case event_type when 'error' then 'FAILED' when 'signup' then 'PENDING' else 'SUCCESS' end status,
       concat('CITY-', cast(cast(json_extract_string(props, '$.k') as int) % 5 as varchar)) "location",
       ts ingestion_timestamp, epoch_us(ts) us, cast(ts as date) tx_date
from events""",
    # ---- cleaned ----
    "clean_customers": """
select * exclude (rn) from (
  select *, row_number() over (partition by customer_id order by name desc nulls last, age desc nulls last,
      gender desc nulls last, city desc nulls last, state desc nulls last, income desc nulls last,
      account_open_date desc nulls last, customer_segment desc nulls last) rn
  from (select customer_id, trim(name) as name, try_cast(age as int) age, lower(gender) gender, city, state,
               try_cast(income as decimal(15,2)) income, try_cast(account_open_date as date) account_open_date,
               customer_segment
        from customers)
  where age >= 18 and customer_id is not null) where rn = 1""",
    "clean_accounts": """
select * exclude (rn) from (
  select *, row_number() over (partition by account_id order by customer_id desc nulls last,
      account_type desc nulls last, branch_id desc nulls last, balance desc nulls last,
      account_status desc nulls last) rn
  from (select account_id, customer_id, account_type, branch_id, try_cast(balance as decimal(15,2)) balance,
               trim(account_status) account_status from accounts)
  where account_id is not null and customer_id is not null) where rn = 1""",
    "clean_tx": """
select * exclude (rn) from (
  select *, row_number() over (partition by transaction_id order by ingestion_timestamp desc nulls last,
      account_id desc nulls last, transaction_type desc nulls last, amount desc nulls last,
      merchant_id desc nulls last, "location" desc nulls last, payment_method desc nulls last,
      status desc nulls last, channel desc nulls last, transaction_timestamp desc nulls last) rn
  from tx where transaction_id is not null and account_id is not null and amount > 0) where rn = 1""",
    "clean_branches": """
select branch_id, trim(branch_name) branch_name, city, state, branch_type from branches
where branch_id is not null""",
    "clean_merchants": """
select merchant_id, trim(merchant_name) merchant_name, merchant_category, city from merchants
where merchant_id is not null""",
    "risky_merchants": """
select *, case when merchant_category in ('Travel', 'Electronics') then 'HIGH'
               when merchant_category in ('Entertainment', 'Fuel', 'Shopping') then 'MEDIUM'
               when merchant_category in ('Grocery', 'Restaurant', 'Healthcare', 'Education', 'Utilities') then 'LOW'
          end risk_category
from clean_merchants""",
    "profiles": """
select a.account_id, c.customer_id, c.customer_segment, c.city customer_city, a.account_type, a.branch_id
from clean_accounts a left join clean_customers c on a.customer_id = c.customer_id""",
    "scored": """
select *, 50 * cast(high as int) + 20 * cast(risky as int) fraud_score from (
  select *, coalesce(amount > 10000, false) high, coalesce(channel = 'Online', false) risky from clean_tx)""",
    "fact": """
select t.transaction_id, t.account_id, p.customer_id, t.merchant_id, p.branch_id,
       cast(strftime(t.transaction_timestamp, '%Y%m%d') as int) date_id, t.transaction_type, t.amount,
       t.transaction_timestamp, t.status, t.payment_method, t.channel, t."location"
from clean_tx t left join profiles p on t.account_id = p.account_id""",
    # ---- quality ----
    "dup_ids": """
select transaction_id, count(*) cnt from tx where transaction_id is not null
group by transaction_id having count(*) > 1""",
    "judged": """
select t.*,
  (transaction_id is null or account_id is null or amount is null or transaction_timestamp is null
   or transaction_type is null or status is null) as incomplete,
  not coalesce(amount between 1 and 10000000, false) as out_of_range,
  coalesce(transaction_type not in ('UPI', 'CARD', 'ATM', 'NEFT', 'IMPS', 'RTGS', 'CASH_DEPOSIT',
           'CASH_WITHDRAWAL'), false) as bad_type,
  coalesce(status not in ('SUCCESS', 'FAILED', 'PENDING'), false) as bad_status,
  coalesce(channel not in ('Mobile', 'Internet Banking', 'ATM', 'Branch', 'POS'), false) as bad_channel,
  coalesce(transaction_id in (select transaction_id from dup_ids), false) as repeated,
  coalesce(transaction_timestamp > timestamp '1998-06-01', false) as future,
  account_id is not null and account_id not in
    (select account_id from accounts where account_id is not null) as orphan
from tx t""",
    "good": """
select * from judged
where not (incomplete or out_of_range or bad_type or bad_status or bad_channel or future or orphan)""",
    # ---- window rules ----
    "seen": """
select *,
  count(*) over (partition by account_id order by us range between 600000000 preceding and current row) recent_count,
  min("location") over (partition by account_id order by us range between 1800000000 preceding and current row) lo,
  max("location") over (partition by account_id order by us range between 1800000000 preceding and current row) hi,
  coalesce(sum(case when status = 'FAILED' then 1 else 0 end) over (partition by account_id order by us
           range between 43200000000 preceding and 1 preceding), 0) recent_failed,
  count(*) over (partition by account_id order by us range between unbounded preceding and 1 preceding) prior_count,
  sum(amount) over (partition by account_id order by us range between unbounded preceding and 1 preceding) prior_amount,
  min(us) over (partition by account_id) first_us
from tx_events""",
    "days": """
select account_id, tx_date, count(*) day_count from tx_events group by account_id, tx_date""",
    "busy": """
select account_id, tx_date, day_count from (
  select *, count(*) over w active_days, sum(day_count) over w days_total from days
  window w as (partition by account_id order by tx_date
               range between interval 30 days preceding and interval 1 day preceding))
where day_count * active_days > 3 * days_total""",
    "rules": """
select s.*, b.day_count, recent_count >= 2 as is_high_velocity, lo <> hi as is_impossible_location,
  coalesce(prior_count > 0 and us - first_us >= 7 * 86400000000 and amount * prior_count > 5 * prior_amount, false)
    as is_large_transaction,
  status = 'SUCCESS' and recent_failed >= 2 as is_failed_then_success,
  b.day_count is not null as is_unusual_frequency
from seen s left join busy b on s.account_id = b.account_id and s.tx_date = b.tx_date""",
    "risks": """
select *, case when risk_score = 0 then null when risk_score < 40 then 'LOW' when risk_score < 60 then 'MEDIUM'
               when risk_score < 80 then 'HIGH' else 'CRITICAL' end severity
from (select *, least(100, 40 * cast(is_high_velocity as int) + 80 * cast(is_impossible_location as int)
        + 60 * cast(is_large_transaction as int) + 50 * cast(is_failed_then_success as int)
        + 30 * cast(is_unusual_frequency as int)) risk_score from rules)""",
    "alerts": """
select *, rank() over (order by risk_score desc) alert_rank from (
  select *, 'HIGH_VELOCITY' as rule from risks where is_high_velocity
  union all select *, 'IMPOSSIBLE_LOCATION' from risks where is_impossible_location
  union all select *, 'LARGE_TRANSACTION' from risks where is_large_transaction
  union all select *, 'FAILED_THEN_SUCCESS' from risks where is_failed_then_success
  union all select *, 'UNUSUAL_FREQUENCY' from risks where is_unusual_frequency)""",
}

_NEEDS = {
    "tx": ["tx_bulk"], "clean_customers": ["customers"], "clean_accounts": ["accounts"], "clean_tx": ["tx"],
    "clean_branches": ["branches"], "clean_merchants": ["merchants"], "risky_merchants": ["clean_merchants"],
    "profiles": ["clean_accounts", "clean_customers"], "scored": ["clean_tx"], "fact": ["clean_tx", "profiles"],
    "dup_ids": ["tx"], "judged": ["tx", "dup_ids", "accounts"], "good": ["judged"], "seen": ["tx_events"],
    "days": ["tx_events"], "busy": ["days"], "rules": ["seen", "busy"], "risks": ["rules"], "alerts": ["risks"],
}


def _with(views: str, select: str) -> str:
    """The select, preceded by the views it needs in dependency order."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for view in views.split():
        add(view)
    return "with " + ",\n".join(f"{v} as ({_VIEWS[v]})" for v in wanted) + "\n" + select.strip()


_TS = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') {1}"


def _ts(column: str, name: str | None = None) -> str:
    return _TS.format(column, name or column)


_HIT = f"transaction_id, account_id, cast(amount as double) amount, {_ts('transaction_timestamp')}"
_TX = (
    "transaction_id, account_id, transaction_type, cast(amount as double) amount, merchant_id, \"location\", "
    f"payment_method, status, channel, {_ts('ingestion_timestamp')}, {_ts('transaction_timestamp')}"
)
_FAILING = (
    "select transaction_id, account_id, cast(amount as double) amount, status, channel, "
    f"{_ts('transaction_timestamp')}, '{{0}}' failure_reason from judged where {{1}}"
)
_CUSTOMER = (
    "customer_id, name, age, gender, city, state, cast(income as double) income, "
    "strftime(account_open_date, '%Y-%m-%d') account_open_date, customer_segment"
)
_ACCOUNT = "account_id, customer_id, account_type, branch_id, cast(balance as double) balance, account_status"
_RULE_ROWS = [
    ("COMPLETENESS", "COMPLETENESS", "transaction_id,account_id,amount,transaction_timestamp,transaction_type,status",
     "incomplete", "Missing critical values"),
    ("RANGE_amount", "RANGE", "amount", "out_of_range", "Out of range: amount"),
    ("VALIDITY_transaction_type", "VALIDITY", "transaction_type", "bad_type", "Invalid value: transaction_type"),
    ("VALIDITY_status", "VALIDITY", "status", "bad_status", "Invalid value: status"),
    ("VALIDITY_channel", "VALIDITY", "channel", "bad_channel", "Invalid value: channel"),
    ("UNIQUENESS_transaction_id", "UNIQUENESS", "transaction_id", "repeated", "Duplicate transaction_id"),
    ("TIMESTAMP_transaction_timestamp", "TIMESTAMP", "transaction_timestamp", "future",
     "Future timestamp: transaction_timestamp"),
    ("REFERENTIAL_account_id", "REFERENTIAL", "account_id", "orphan", "Unknown account_id"),
]


_CUSTOMER_RULES = [
    ("COMPLETENESS", "COMPLETENESS", "customer_id,name,age", "customer_id is null or name is null or try_cast(age as int) is null"),
    ("RANGE_age", "RANGE", "age", "not coalesce(try_cast(age as int) between 18 and 100, false)"),
    ("VALIDITY_customer_segment", "VALIDITY", "customer_segment",
     "coalesce(customer_segment not in ('Regular', 'Premium', 'High Net Worth', 'Student', 'Senior'), false)"),
    ("UNIQUENESS_customer_id", "UNIQUENESS", "customer_id",
     "customer_id in (select customer_id from customers where customer_id is not null group by 1 having count(*) > 1)"),
]
_ACCOUNT_RULES = [
    ("COMPLETENESS", "COMPLETENESS", "account_id,customer_id,balance",
     "account_id is null or customer_id is null or try_cast(balance as decimal(15,2)) is null"),
    ("RANGE_balance", "RANGE", "balance", "not coalesce(try_cast(balance as decimal(15,2)) >= 0, false)"),
    ("VALIDITY_account_status", "VALIDITY", "account_status",
     "coalesce(trim(account_status) not in ('ACTIVE', 'BLOCKED', 'CLOSED'), false)"),
    ("UNIQUENESS_account_id", "UNIQUENESS", "account_id",
     "account_id in (select account_id from accounts where account_id is not null group by 1 having count(*) > 1)"),
    ("REFERENTIAL_customer_id", "REFERENTIAL", "customer_id",
     "customer_id is not null and customer_id not in (select customer_id from clean_customers)"),
]


def _result_rows(rows, view: str = "judged", dataset: str = "transactions") -> str:
    counted = "\nunion all ".join(
        f"select '{name}' check_name, '{kind}' check_type, '{cols}' \"columns\", count(*) total_records, "
        f"count(*) filter (where {flag}) failed_records from {view}"
        for name, kind, cols, flag, *_ in rows
    )
    return f"""
select '{dataset}' dataset, check_name, check_type, "columns", total_records,
       total_records - failed_records passed_records, failed_records, pass_rate,
       case when failed_records = 0 then 'PASS' when pass_rate >= 95 then 'WARN' else 'FAIL' end status
from (select *, (total_records - failed_records) / total_records * 100 pass_rate from ({counted}))"""


def _reconciled(arrived: str) -> str:
    """Sides counted each by itself: source rows, kept rows that arrived, rows that fail a rule plus left-out copies."""
    failing = "(incomplete or out_of_range or bad_type or bad_status or bad_channel or future or orphan)"
    return f"""
, ranked as (select *, row_number() over (partition by transaction_id order by
               ingestion_timestamp desc nulls last, account_id desc nulls last, transaction_type desc nulls last,
               amount desc nulls last, merchant_id desc nulls last, "location" desc nulls last,
               payment_method desc nulls last, status desc nulls last, channel desc nulls last) rn
             from judged where not {failing}),
source as (select count(*) n, coalesce(sum(amount), 0) amount from judged),
target as (select count(*) n, coalesce(sum(amount), 0) amount from ranked where rn = 1 and {arrived}),
left_out as (select amount from judged where {failing} union all select amount from ranked where rn > 1),
rejected as (select count(*) n, coalesce(sum(amount), 0) amount from left_out),
sides as (select s.n source_count, t.n target_count, r.n rejected_count, s.amount source_amount, t.amount target_amount,
                 r.amount rejected_amount, s.n - t.n - r.n count_difference, s.amount - t.amount - r.amount amount_difference
          from source s, target t, rejected r)
select 'transactions' dataset, source_count, target_count, rejected_count, cast(source_amount as double) source_amount,
       cast(target_amount as double) target_amount, cast(rejected_amount as double) rejected_amount, count_difference,
       cast(amount_difference as double) amount_difference,
       if(count_difference = 0, 'PASS', 'FAIL') count_status, if(amount_difference = 0, 'PASS', 'FAIL') amount_status,
       if(count_difference = 0 and amount_difference = 0, 'PASS', 'FAIL') overall_status
from sides"""


def _scd2(clean: str, key: str, prefix: int, columns: list[str], shown: str, changed: str, value: str) -> str:
    number = f"cast(substring({key}, {prefix + 1}) as bigint)"
    same = " and ".join(f"o.{c} is not distinct from n.{c}" for c in columns)
    first, second, last = "2020-01-01 00:00:00.000000", "2024-01-01 00:00:00.000000", "9999-12-31 00:00:00.000000"
    return f""",
o as (select * from {clean} where {number} % 25 <> 0),
n as (select * replace ({value} as {changed}) from {clean} where {number} % 17 <> 0),
pairs as (select o.{key} old_key, n.{key} new_key, coalesce({same}, false) as same
          from o full outer join n on o.{key} = n.{key})
select {shown}, not (new_key is not null and not same) is_active, '{first}' valid_from,
       case when new_key is not null and not same then '{second}' else '{last}' end valid_to
from o join pairs on o.{key} = pairs.old_key
union all
select {shown}, true, '{second}', '{last}' from n join pairs on n.{key} = pairs.new_key
where old_key is null or not same"""


_CUSTOMER_COLUMNS = ["name", "age", "gender", "city", "state", "income", "account_open_date", "customer_segment"]


def _versions(name: str, seen: str, key: str, columns: list[str]) -> str:
    """Common table expressions that turn snapshots (`seen` has key, columns and as_of) into versions."""
    values = ", ".join(columns)
    return f""",
{name}_seen as ({seen}),
{name}_starts as (select * from (select *, row({values}) is distinct from lag(row({values})) over w
                      or lag(as_of) over w is null fresh from {name}_seen window w as (partition by {key} order by as_of)) where fresh),
{name} as (select {key}, {values}, lead(as_of) over w is null is_active, as_of valid_from,
                  coalesce(lead(as_of) over w, timestamp '9999-12-31') valid_to
           from {name}_starts window w as (partition by {key} order by as_of))"""


_CUSTOMER_VERSIONS = _versions("customer_versions", """
  select * replace (case when as_of = timestamp '1997-01-01' and n % 10 = 1 then null
                         when as_of in (timestamp '1995-03-01', timestamp '1997-01-01') and n % 10 = 0 then 'Premium'
                         else customer_segment end as customer_segment)
  from (select *, cast(substring(customer_id, 6) as bigint) n from clean_customers),
       (values (timestamp '1993-01-01', 25), (timestamp '1995-03-01', 0), (timestamp '1996-01-01', 7), (timestamp '1997-01-01', 17)) s(as_of, without)
  where without = 0 or n % without <> 0""", "customer_id", _CUSTOMER_COLUMNS)

_ACCOUNT_VERSIONS = _versions("account_versions", """
  select account_id, as_of,
         case when as_of = timestamp '1997-01-01' and n % 10 = 1 then 'CUST-0000001' else customer_id end customer_id,
         case when as_of = timestamp '1995-03-01' and n % 10 = 0 then 'BRN-0000' else branch_id end branch_id
  from (select *, cast(substring(account_id, 5) as bigint) n from clean_accounts),
       (values (timestamp '1993-01-01', 25), (timestamp '1995-03-01', 0), (timestamp '1997-01-01', 17)) s(as_of, without)
  where without = 0 or n % without <> 0""", "account_id", ["customer_id", "branch_id"])


ORACLES: dict[str, str] = {
    "clean_customers": _with("clean_customers", f"select {_CUSTOMER} from clean_customers"),
    "clean_accounts": _with("clean_accounts", f"select {_ACCOUNT} from clean_accounts"),
    "clean_transactions": _with("clean_tx", f"select {_TX} from clean_tx"),
    "clean_branches": _with("clean_branches", "select * from clean_branches"),
    "clean_merchants": _with("clean_merchants", "select * from clean_merchants"),
    "valid_customer_keys": _with(
        "customers", "select customer_id, customer_segment from customers where customer_id is not null"),
    "merchant_risk": _with(
        "risky_merchants", "select merchant_id, merchant_category, risk_category from risky_merchants"),
    "union_batches": _with("tx", """
select transaction_type, case when status <> 'PENDING' then payment_method end payment_method,
       count(*) records, cast(cast(sum(amount) as decimal(20,2)) as double) amount
from tx group by all"""),
    "files_manifest": " union all ".join(
        f"select '{t}.parquet' file_name, count(*) records from {t}"
        for t in ("customer", "events", "lineitem", "nation", "orders", "region", "supplier")),
    "ingest_summary": """
with per_dataset as (
  select 'branches' dataset, count(*) records from nation union all
  select 'merchants', count(*) from supplier union all
  select 'customers', count(*) from customer union all
  select 'accounts', count(*) from customer union all
  select 'transactions', count(*) from lineitem)
select dataset, records, cast(1 as bigint) batches from per_dataset
union all select 'TOTAL', cast(sum(records) as bigint), count(*) from per_dataset""",
    "sample_n": _with("branches merchants customers accounts", " union all ".join(
        f"(select '{t}' dataset, {k} record_id from {t} order by md5(concat(coalesce({k}, ''), '#42')), {k} limit {n})"
        for t, k, n in (("branches", "branch_id", 20), ("merchants", "merchant_id", 50),
                        ("customers", "customer_id", 100), ("accounts", "account_id", 200)))),
    "enrich_customers": _with("clean_customers", """
select customer_id, date_diff('day', account_open_date, date '2024-12-31') / 365 tenure_years,
       coalesce(income > 150000, false) high_income_flag from clean_customers"""),
    "enrich_transactions": _with("clean_tx profiles", f"""
select t.transaction_id, t.account_id, merchant_id, transaction_type, cast(amount as double) amount,
       {_ts('transaction_timestamp')}, status, channel, customer_id, customer_segment, customer_city, account_type,
       cast(year(t.transaction_timestamp) as int) tx_year, cast(month(t.transaction_timestamp) as int) tx_month,
       cast(dayofweek(t.transaction_timestamp) + 1 as int) tx_day_of_week,
       coalesce(dayofweek(t.transaction_timestamp) in (0, 6), false) is_weekend
from clean_tx t left join profiles p on t.account_id = p.account_id"""),
    # ---- quality ----
    "dq_completeness": _with("tx", """
select transaction_id, account_id, cast(amount as double) amount, merchant_id,
       'Missing critical values' failure_reason
from tx where transaction_id is null or account_id is null or amount is null"""),
    "dq_uniqueness": _with("judged", _result_rows([r for r in _RULE_ROWS if r[1] == "UNIQUENESS"])),
    "dq_uniqueness_failed": _with("dup_ids", """
select transaction_id, account_id, cast(amount as double) amount, merchant_id,
       'Duplicate transaction_id' failure_reason
from tx where transaction_id in (select transaction_id from dup_ids)"""),
    "dq_uniqueness_passed": _with("dup_ids", """
select transaction_id, account_id, cast(amount as double) amount, merchant_id
from tx where transaction_id is null or transaction_id not in (select transaction_id from dup_ids)"""),
    "dup_keys": _with("dup_ids", "select * from dup_ids"),
    "dq_range": _with("customers accounts tx", """
select customer_id record_id, cast(try_cast(age as int) as double) as value, 'Out of range: age' failure_reason
from customers where not coalesce(try_cast(age as int) between 18 and 100, false)
union all
select account_id, cast(try_cast(balance as decimal(15,2)) as double), 'Out of range: balance'
from accounts where not coalesce(try_cast(balance as decimal(15,2)) >= 0, false)
union all
select transaction_id, cast(amount as double), 'Out of range: amount'
from tx where not coalesce(amount between 1 and 10000000, false)"""),
    "dq_validity": _with("judged", _FAILING.format("Invalid value: channel", "bad_channel")),
    "dq_referential": _with("judged", _FAILING.format("Unknown account_id", "orphan")),
    "dq_timestamp": _with("judged", _FAILING.format("Future timestamp: transaction_timestamp", "future")),
    "dq_results": _with("judged", _result_rows(_RULE_ROWS)),
    "dq_customers": _with("customers", _result_rows(_CUSTOMER_RULES, "customers", "customers")),
    "dq_accounts": _with("accounts clean_customers", _result_rows(_ACCOUNT_RULES, "accounts", "accounts")),
    "dq_validity_domains": _with("judged accounts customers", """
select transaction_id record_id, 'VALIDITY_transaction_type' failed_rule from judged where bad_type
union all select transaction_id, 'VALIDITY_status' from judged where bad_status
union all select transaction_id, 'VALIDITY_channel' from judged where bad_channel
union all select account_id, 'VALIDITY_account_status' from accounts
          where trim(account_status) not in ('ACTIVE', 'BLOCKED', 'CLOSED')
union all select customer_id, 'VALIDITY_customer_segment' from customers
          where customer_segment not in ('Regular', 'Premium', 'High Net Worth', 'Student', 'Senior')"""),
    "dq_rejected": _with("judged", "\nunion all ".join(
        f"select transaction_id record_id, '{name}' failed_rule, '{reason}' failure_reason from judged where {flag}"
        for name, kind, _, flag, reason in _RULE_ROWS if kind != "UNIQUENESS")),
    "dq_passed": _with(
        "good", "select transaction_id, account_id, cast(amount as double) amount, status, channel from good"),
    # ---- fraud ----
    "fraud_basic": _with("scored", """
select transaction_id, cast(amount as double) amount, channel, high fraud_flag_high_amount,
       risky fraud_flag_risky_merchant, fraud_score, fraud_score >= 50 is_fraudulent from scored"""),
    "fraud_risky_merchant_dim": _with("clean_tx risky_merchants", """
select transaction_id, t.merchant_id, risk_category merchant_risk_category,
       coalesce(risk_category = 'HIGH', false) fraud_flag_risky_merchant
from clean_tx t left join risky_merchants m on t.merchant_id = m.merchant_id"""),
    "fraud_velocity": _with("rules", f"select {_HIT}, recent_count from rules where is_high_velocity"),
    "fraud_impossible_location": _with(
        "rules", f'select {_HIT}, "location" from rules where is_impossible_location'),
    "fraud_distance": _with("tx_events", f"""
, geo as (select concat('CITY-', cast(n_nationkey as varchar)) city, radians(10 + 2 * n_nationkey) lat, radians(3 * n_nationkey) lon
          from nation where n_nationkey < 4),
placed as (select account_id, us, lat, lon from tx_events join geo on "location" = city),
pairs as (select distinct a.account_id, a.us first_us, b.us last_us from placed a join placed b
          on a.account_id = b.account_id and a.us <= b.us and b.us - a.us <= 1800000000
          where 2 * 6371 * asin(sqrt(pow(sin((b.lat - a.lat) / 2), 2) + cos(a.lat) * cos(b.lat) * pow(sin((b.lon - a.lon) / 2), 2))) >= 500)
select {_HIT}, "location" from tx_events e
where exists (select 1 from pairs p where p.account_id = e.account_id and p.last_us <= e.us and p.first_us >= e.us - 1800000000)"""),
    "fraud_large_tx": _with("rules", f"""
select {_HIT}, prior_count, cast(cast(prior_amount as decimal(28,2)) as double) prior_amount
from rules where is_large_transaction"""),
    "fraud_failed_then_success": _with("rules", f"""
select {_HIT}, cast(recent_failed as bigint) recent_failed from rules where is_failed_then_success"""),
    "fraud_unusual_frequency": _with("rules", f"select {_HIT}, day_count from rules where is_unusual_frequency"),
    "fraud_score": _with("risks", """
select transaction_id, account_id, is_high_velocity, is_impossible_location, is_large_transaction,
       is_failed_then_success, is_unusual_frequency, risk_score, severity from risks"""),
    "fraud_alerts": _with("alerts", """
select transaction_id, account_id, rule, cast(amount as double) amount, risk_score, severity, alert_rank from alerts"""),
    "fraud_by_rule": _with("alerts", """
select severity, rule, count(*) alerts, cast(cast(sum(amount) as decimal(20,2)) as double) amount
from alerts group by severity, rule"""),
    "fraud_trend": _with("risks", """
, daily as (select severity, tx_date, count(*) alerted from risks where risk_score > 0 group by severity, tx_date)
select severity, strftime(tx_date, '%Y-%m-%d') alert_date, alerted,
       alerted - lag(alerted, 1, 0) over (partition by severity order by tx_date) change,
       cast(sum(alerted) over (partition by severity order by tx_date
            range between interval 6 days preceding and current row) as bigint) moving_total
from daily"""),
    # ---- warehouse ----
    "dim_date": _with("tx", """
, days as (select cast(unnest(generate_series(cast(min(transaction_timestamp) as date),
                  cast(max(transaction_timestamp) as date), interval 1 day)) as date) d from tx)
select cast(strftime(d, '%Y%m%d') as int) date_id, strftime(d, '%Y-%m-%d') full_date,
       cast(day(d) as int) day_of_month, cast(month(d) as int) as "month", cast(year(d) as int) as "year",
       cast(quarter(d) as int) as "quarter", dayname(d) day_of_week, dayofweek(d) in (0, 6) is_weekend
from days"""),
    "scd2_customer": _with("clean_customers", _scd2(
        "clean_customers", "customer_id", 5,
        ["name", "age", "gender", "city", "state", "income", "account_open_date", "customer_segment"],
        _CUSTOMER, "customer_segment",
        """case cast(substring(customer_id, 6) as bigint) % 10 when 0 then 'Premium' when 1 then null
           else customer_segment end""")),
    "scd2_account": _with("clean_accounts", _scd2(
        "clean_accounts", "account_id", 4,
        ["customer_id", "account_type", "branch_id", "balance", "account_status"], _ACCOUNT, "balance",
        """cast(case when cast(substring(account_id, 5) as bigint) % 10 = 0 then balance + 1
           else balance end as decimal(15,2))""")),
    "scd2_late": _with("clean_customers", _CUSTOMER_VERSIONS + f"""
select customer_id, name, age, gender, city, state, cast(income as double) income, strftime(account_open_date, '%Y-%m-%d') account_open_date,
       customer_segment, is_active, {_ts('valid_from')}, {_ts('valid_to')} from customer_versions"""),
    "fact_as_of": _with("clean_tx clean_accounts clean_customers", _ACCOUNT_VERSIONS + _CUSTOMER_VERSIONS + f"""
select transaction_id, t.account_id, c.customer_id, merchant_id, a.branch_id,
       cast(strftime(transaction_timestamp, '%Y%m%d') as int) date_id, transaction_type, cast(amount as double) amount,
       {_ts('transaction_timestamp')}, status, payment_method, channel, "location"
from clean_tx t
asof left join account_versions a on t.account_id = a.account_id and t.transaction_timestamp >= a.valid_from
asof left join customer_versions c on a.customer_id = c.customer_id and t.transaction_timestamp >= c.valid_from"""),
    "customers_in_force": _with("clean_tx clean_accounts clean_customers", _ACCOUNT_VERSIONS + _CUSTOMER_VERSIONS + f"""
, first_account as (select account_id, arg_min(customer_id, valid_from) customer_id from account_versions group by 1),
first_customer as (select customer_id, arg_min(row(customer_segment, valid_from), valid_from) f from customer_versions group by 1),
owned as (select t.transaction_id, t.account_id, t.transaction_timestamp, coalesce(a.customer_id, f.customer_id) customer_id
          from clean_tx t
          asof left join account_versions a on t.account_id = a.account_id and t.transaction_timestamp >= a.valid_from
          left join first_account f on t.account_id = f.account_id)
select transaction_id, account_id, {_ts('transaction_timestamp')}, o.customer_id,
       case when c.customer_id is null then f.f[1] else c.customer_segment end customer_segment,
       {_ts('coalesce(c.valid_from, f.f[2])', 'valid_from')}
from owned o
asof left join customer_versions c on o.customer_id = c.customer_id and o.transaction_timestamp >= c.valid_from
left join first_customer f on o.customer_id = f.customer_id"""),
    "scd1_merchant": _with("risky_merchants", """
select merchant_id, case when n % 3 <> 0 then upper(merchant_name) else merchant_name end merchant_name,
       merchant_category, city, risk_category
from (select *, cast(substring(merchant_id, 5) as bigint) n from risky_merchants)
where n % 3 <> 0 or n % 7 <> 0"""),
    "scd1_branch": _with("clean_branches", """
select branch_id, branch_name, city, state, case when n % 3 <> 0 then 'Metro' else branch_type end branch_type
from (select *, cast(substring(branch_id, 5) as bigint) n from clean_branches)
where n % 3 <> 0 or n % 7 <> 0"""),
    "fact_transactions": _with("fact", f"""
select transaction_id, account_id, customer_id, merchant_id, branch_id, date_id, transaction_type,
       cast(amount as double) amount, {_ts('transaction_timestamp')}, status, payment_method, channel, "location"
from fact"""),
    "upsert_transactions": _with("clean_tx", f"""
select transaction_id, account_id, cast(amount as double) amount,
       case when ingestion_timestamp > timestamp '1996-07-01' then 'SETTLED' else status end status,
       {_ts('ingestion_timestamp')} from clean_tx"""),
    # ---- summaries ----
    "merchant_risk_counts": _with(
        "risky_merchants", "select risk_category, count(*) merchants from risky_merchants group by risk_category"),
    "daily_branch_metrics": _with("fact", """
select date_id, branch_id, count(*) total_transactions,
       cast(coalesce(sum(amount) filter (where status = 'SUCCESS' and transaction_type = 'CASH_DEPOSIT'), 0)
            as double) total_inflow,
       cast(coalesce(sum(amount) filter (where status = 'SUCCESS' and transaction_type <> 'CASH_DEPOSIT'), 0)
            as double) total_outflow,
       count(distinct customer_id) unique_customers
from fact where branch_id is not null and date_id is not null group by date_id, branch_id"""),
    "customer_segment_summary": _with("clean_tx clean_accounts clean_customers", """
, joined as (
  select cast(strftime(t.transaction_timestamp, '%Y%m') as int) month_id, c.customer_segment, c.customer_id, c.age,
         a.account_id, a.balance, t.amount
  from clean_tx t join clean_accounts a on t.account_id = a.account_id
  join clean_customers c on a.customer_id = c.customer_id),
people as (select month_id, customer_segment, count(*) total_customers,
                  cast((2 * sum(age) + count(*)) // (2 * count(*)) as int) avg_age
           from (select distinct month_id, customer_segment, customer_id, age from joined) group by all),
money as (select month_id, customer_segment, cast(sum(balance) as double) total_balance
          from (select distinct month_id, customer_segment, account_id, balance from joined) group by all),
big as (select month_id, customer_segment, count(*) filter (where amount > 10000) high_value_transactions
        from joined group by all)
select month_id, customer_segment, total_customers, avg_age, total_balance, high_value_transactions
from people join money using (month_id, customer_segment) join big using (month_id, customer_segment)"""),
    "active_accounts_by_period": _with("clean_tx clean_accounts", """
, days as (select cast(transaction_timestamp as date) d, t.account_id
           from clean_tx t join clean_accounts a on t.account_id = a.account_id where transaction_timestamp is not null)
select strftime(d, '%Y-%m') period, count(distinct account_id) active_accounts from days group by all
union all select strftime(d, '%Y') || '-Q' || quarter(d), count(distinct account_id) from days group by all
union all select strftime(d, '%Y'), count(distinct account_id) from days group by all"""),
    "fraud_summary": _with("scored risky_merchants", """
select cast(strftime(transaction_timestamp, '%Y%m%d') as int) date_id, risk_category merchant_risk_category, channel,
       count(*) filter (where fraud_score > 0) flagged_transactions,
       cast(coalesce(sum(amount) filter (where fraud_score > 0), 0) as double) flagged_amount,
       count(*) filter (where fraud_score >= 50) confirmed_fraud
from scored s left join risky_merchants m on s.merchant_id = m.merchant_id group by all"""),
    "exec_overview": _with("clean_tx", """
select count(*) total_transactions, cast(sum(amount) as double) total_value,
       count(*) filter (where status = 'SUCCESS') successful,
       count(*) filter (where status = 'SUCCESS') / count(*) * 100 success_rate from clean_tx"""),
    "top_customers": _with("clean_tx profiles", """
, sums as (select customer_id, count(*) transactions,
                  coalesce(sum(amount) filter (where status = 'SUCCESS'), 0) spent
           from clean_tx t join profiles p on t.account_id = p.account_id
           where customer_id is not null group by customer_id)
select customer_id, transactions, cast(spent as double) spent from sums
order by sums.spent desc, customer_id limit 10"""),
    "segment_spend": _with("clean_tx profiles", """
select customer_segment, count(distinct customer_id) customers, count(*) transactions,
       cast(coalesce(sum(amount) filter (where status = 'SUCCESS'), 0) as double) spent
from clean_tx t join profiles p on t.account_id = p.account_id
where customer_segment is not null group by customer_segment"""),
    "branch_rollup": _with("clean_tx clean_accounts clean_branches", """
, placed as (select t.*, coalesce(b.state, 'UNKNOWN') state, coalesce(b.city, 'UNKNOWN') city
             from clean_tx t left join clean_accounts a on t.account_id = a.account_id
             left join clean_branches b on a.branch_id = b.branch_id)
select state, city, cast(grouping_id(state, city) as int) "level", count(*) transactions,
       count(*) filter (where status = 'SUCCESS') successful, cast(sum(amount) as double) amount
from placed group by rollup (state, city)"""),
    "reconcile": _with("judged", _reconciled("true")),
    "reconcile_shortfall": _with("judged", _reconciled("status <> 'PENDING'")),
    "pipeline_slice": _with("judged", """
, rejected as (select * from judged where incomplete or out_of_range or bad_type or bad_status or bad_channel or future or orphan),
good as (select * from judged where not (incomplete or out_of_range or bad_type or bad_status or bad_channel or future or orphan)),
early as (select transaction_id, arg_max(struct_pack(i := ingestion_timestamp, a := amount, s := status),
                 struct_pack(i := ingestion_timestamp, a := amount, s := status, x := account_id, t := transaction_timestamp)) r
          from good where ingestion_timestamp <= timestamp '1996-01-01' group by transaction_id),
late as (select transaction_id, arg_max(struct_pack(i := ingestion_timestamp, a := amount, s := 'SETTLED'),
                 struct_pack(i := ingestion_timestamp, a := amount, s := status, x := account_id, t := transaction_timestamp)) r
         from good where ingestion_timestamp > timestamp '1995-12-30' group by transaction_id),
merged as (select r from late union all
           select r from early where transaction_id not in (select transaction_id from late)),
outcomes as (select r.i ingestion_timestamp, r.a amount, 'LOADED ' || r.s outcome from merged
             union all select ingestion_timestamp, amount, 'REJECTED' from rejected)
select cast(strftime(ingestion_timestamp, '%Y%m') as int) month_id, outcome, count(*) records,
       cast(coalesce(sum(amount), 0) as double) amount
from outcomes group by all"""),
    # ---- incremental ----
    "incremental_filter": _with(
        "tx_events", f"select {_HIT} from tx_events where ingestion_timestamp > timestamp '2024-01-15'"),
    "incremental_late": _with(
        "tx_events", f"select {_HIT} from tx_events where ingestion_timestamp > timestamp '2024-01-13'"),
    "watermark_next": _with("tx_events", f"""
select {_ts("greatest(max(ingestion_timestamp), timestamp '2024-01-15')", 'last_processed')} from tx_events"""),
    "watermark_accepted": _with("judged", f"""
select {_ts("greatest(max(ingestion_timestamp), timestamp '1992-01-01')", 'last_processed')} from judged
where not (incomplete or out_of_range or bad_type or bad_status or bad_channel or future)
  and ingestion_timestamp <= timestamp '1998-06-01'"""),
    "watermark_get": _with("tx_events", f"""
select 'transactions' dataset, {_ts('max(ingestion_timestamp)', 'last_processed')},
       strftime(max(tx_date), '%Y%m%d') last_run_id,
       {_ts('cast(max(tx_date) as timestamp)', 'updated_at')} from tx_events"""),
}
# another way to the same rows
ORACLES["segment_summary_by_sets"] = ORACLES["customer_segment_summary"]
