"""What is read (``inputs``) and what is produced (``tables`` and the family modules)."""
