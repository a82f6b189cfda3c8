"""gridpulse: outage reliability analytics (SAIDI / SAIFI) as Spark DataFrame plans.

Entry points: ``gridpulse.plans.daily.metric_daily`` (reports -> metrics),
``gridpulse.plans.jobs`` (daily run, backfill, mapping build) and
``gridpulse.streaming.incremental`` (file-stream trigger).
"""

__version__ = "0.1.0"
