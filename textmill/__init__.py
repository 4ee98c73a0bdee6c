"""textmill: labelled-text preparation and small text models as Spark jobs."""
