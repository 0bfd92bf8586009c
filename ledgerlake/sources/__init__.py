"""Where tables live and how they are read and written."""
