"""Stage compositions: clean -> master -> features -> scores -> reports."""
