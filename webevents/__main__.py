from webevents.cli import main

main()
