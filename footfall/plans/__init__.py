"""The jobs a user runs, as DataFrame -> DataFrame plans."""
