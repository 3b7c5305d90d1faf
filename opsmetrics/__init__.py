"""Operations reports on server fleets and data platforms, as Spark jobs."""
