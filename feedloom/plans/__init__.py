"""Query plans users call: hourly activity, series, daily summaries, dashboard, ad-hoc SQL, probes."""
