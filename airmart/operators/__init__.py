"""DataFrame -> DataFrame operators of the mart: clean, consumption, star, views, dashboards, quality."""
