class NoRelevantData(Exception):
    """Raised when the tables an operator needs are not present."""
