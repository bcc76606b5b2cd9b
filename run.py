"""Entry point for spark-submit."""

from millrace.__main__ import main

main()
