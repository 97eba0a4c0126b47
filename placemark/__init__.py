"""Entity-sync analytics (places and events) expressed as Spark jobs."""
