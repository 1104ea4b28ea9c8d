"""millrace: landing, cleaning and analytics of semi-structured records as Spark jobs."""
