"""Agendario: dated-event consolidation and training-data preparation as Spark jobs."""
