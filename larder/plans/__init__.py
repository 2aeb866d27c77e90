"""Multi-operator plans: star schema, end-to-end pipeline, reporting marts, query registry."""
