"""ledgerline: operational reporting jobs as Spark DataFrame plans.

Three reporting domains share one set of column functions and operators:

* ``plans.renewals``  -- renewal funnel, owner leaderboard, cycle retention,
  overdue watchlist and their channel roll-ups;
* ``plans.activity``  -- account-manager reach-out activity per day, agent and
  touchpoint, the forward as-of "first service on/after" join, open backlog and
  the member-level dump;
* ``plans.ranking``   -- support-agent rating bands, weighted score and rank.

Every job is a function from DataFrames to DataFrames with the reporting date
passed in (never ``current_date()``), built only from Spark's own operators.
"""

__all__ = ["session"]
