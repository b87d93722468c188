"""Purchase-behaviour analytics on Spark: ingest, quality, RFM features, clustering, scoring."""
