import sys

from .cli import main

main(sys.argv[1:])
