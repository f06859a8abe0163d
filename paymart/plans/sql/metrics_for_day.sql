-- The by-status mart of one day.
-- Frames: {transactions}, {rates}; parameters: :business_dt, :quote.
WITH per_account AS (
    SELECT currency_code, status, account_number_from,
           SUM(CAST(amount AS DECIMAL(20, 0))) AS amount, COUNT(*) AS cnt
    FROM {transactions}
    WHERE TO_DATE(transaction_dt) = TO_DATE(:business_dt)
      AND account_number_from > 0
      AND account_number_to > 0
    GROUP BY ALL
), cells AS (
    SELECT currency_code, status,
           SUM(amount) AS amount, SUM(cnt) AS cnt,
           BROUND(AVG(cnt), 0) AS avg_cnt, COUNT(*) AS accounts
    FROM per_account
    GROUP BY ALL
), day_rates AS (
    SELECT currency_code,
           SUM(IF(currency_with_div > 0, currency_with_div, 1)) AS rate, COUNT(*) AS copies
    FROM (SELECT DISTINCT currency_code, currency_with_div
          FROM {rates}
          WHERE currency_code_with = :quote AND date_update = TO_DATE(:business_dt))
    GROUP BY ALL
)
SELECT TO_DATE(:business_dt) AS date_update,
       cells.currency_code AS currency_from,
       CAST(BROUND(CAST(amount AS DECIMAL(28, 0)) * COALESCE(rate, 1), 0) AS BIGINT) AS amount_total,
       cnt * COALESCE(copies, 1) AS cnt_transactions,
       avg_cnt AS avg_transactions_per_account,
       accounts AS cnt_accounts_make_transactions,
       status
FROM cells LEFT JOIN day_rates USING (currency_code)
