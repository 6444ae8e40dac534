from lexloom.jobs import main

main()
